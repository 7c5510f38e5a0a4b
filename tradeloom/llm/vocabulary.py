"""Encoding whole texts with a public byte-level BPE vocabulary.

The library is the tokenizer; this module only spares it repeated work. With a
plain byte-level split, a single space between two other characters always
begins a new piece, so the text between such spaces can be encoded on its own
and remembered. Texts where that does not hold go to the library whole.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

MAX_KNOWN = 700_000
_LEARN_WORDS = 2000  # encoded in one string
_FIRST_CHARS = 64  # longer first words are not remembered
_MARKS = ".,;:!?"
_LATIN_END = "\u0250"  # letters and digits below are old enough for every library
# A space between other white space; two spaces and those at an end count as well.
_ODD_SPACE = re.compile(r"[^\S ] [^\S ]")


def byte_of_character() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for bytes."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    table = {chr(b): b for b in plain}
    others = (b for b in range(256) if b not in set(plain))
    table.update({chr(256 + i): b for i, b in enumerate(others)})
    return table


def _edged(word: str) -> bool:
    return word[:1].isspace() or word[-1:].isspace()


class Encoder:
    """Ids of whole texts, as ``encode(text, add_special_tokens=False)`` gives them."""

    def __init__(self, path: str, max_known: int = MAX_KNOWN):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec.get("pre_tokenizer") or {}
        self.special = [t["content"] for t in spec.get("added_tokens") or ()]
        self.by_word = (
            spec.get("normalizer") is None
            and split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space")
        )
        self.max_known = max_known
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # words known before; those met again move to ``known``
        self.firsts: dict[str, bytes] = {}  # words that begin a text have no space before them
        self.marks: dict[str, bytes] = {}
        self.edged: dict[str, bytes] = {}
        if self.by_word:
            stand_in = byte_of_character()
            self.lengths = np.zeros(self.library.get_vocab_size(), dtype=np.int64)
            for token, i in spec["model"]["vocab"].items():
                self.lengths[i] = sum(1 for c in token if c in stand_in)

    def whole(self, text: str) -> np.ndarray:
        (found,) = self.library.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, dtype=np.uint32)

    def _first(self, word: str) -> bytes:
        found = self.firsts.get(word)
        if found is None:
            found = self.whole(word).tobytes()
            if len(word) <= _FIRST_CHARS:
                if len(self.firsts) >= self.max_known:
                    self.firsts = {}
                self.firsts[word] = found
        return found

    def _words(self, text: str) -> list[str] | None:
        if not self.by_word or "  " in text or text[:1] == " " or text[-1:] == " ":
            return None
        return None if any(s in text for s in self.special) else text.split(" ")

    def _learn(self, words: set[str]) -> None:
        """Encode new words in one call and cut the ids at the words' byte lengths.

        Sentence marks after a letter or digit are a piece of their own, so a
        word with marks is the word followed by the marks. Words with white
        space at an end are kept apart: they are looked at again in every text.
        """
        self.edged = {w: self.whole(f" {w}").tobytes() for w in words if _edged(w)}
        marked: list[tuple[str, str]] = []
        plain: set[str] = set()
        for word in words.difference(self.edged, [""]):
            core = word.rstrip(_MARKS)
            if core is not word and core and core[-1] < _LATIN_END and core[-1].isalnum():
                marked.append((word, core))
                if core not in self.known:
                    plain.add(core)
            else:
                plain.add(word)
        self._learn_plain(list(plain))
        for word, core in marked:
            marks = word[len(core) :]
            if marks not in self.marks:
                self.marks[marks] = self.whole(marks).tobytes()
            self.known[word] = self.known[core] + self.marks[marks]

    def _learn_plain(self, order: list[str]) -> None:
        if not order:
            return
        parts = [" " + " ".join(order[i : i + _LEARN_WORDS]) for i in range(0, len(order), _LEARN_WORDS)]
        found = self.library.encode_batch_fast(parts, add_special_tokens=False)
        ids = np.concatenate([np.array(f.ids, dtype=np.uint32) for f in found])
        data = np.frombuffer("".join(parts).encode(), dtype=np.uint8)
        ends = np.append(np.flatnonzero(data == 32)[1:], len(data))
        cuts = np.searchsorted(np.cumsum(self.lengths[ids]), ends) + 1
        packed, at = ids.tobytes(), 0
        for word, cut in zip(order, (cuts * ids.itemsize).tolist(), strict=True):
            self.known[word] = packed[at:cut]
            at = cut

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [self._words(t) for t in texts]
        found = [list(map(self.known.get, s)) if s else None for s in split]
        new: set[str] = set()
        for i, (words, ids) in enumerate(zip(split, found, strict=True)):
            if words is None or None not in ids:
                continue
            missing = [w for w, x in zip(words, ids, strict=True) if x is None]
            if any(map(_edged, missing)) and _ODD_SPACE.search(texts[i]):
                split[i] = None
            else:
                new.update(missing)
        again = {w: self.older[w] for w in new if w in self.older}
        if 2 * (len(self.known) + len(new)) > self.max_known:
            # words that come again soon are taken back, the others go at the next turn
            self.known, self.older = {}, self.known
        self.known |= again
        new.difference_update(again)
        if new:
            self._learn(new)
        return [self._joined(*x) for x in zip(texts, split, found, strict=True)]

    def _joined(self, text: str, words: list[str] | None, found: list[bytes | None] | None) -> np.ndarray:
        if words is None:
            return self.whole(text)
        found[0] = self._first(words[0])
        if None in found:
            known, edged = self.known, self.edged
            found = [
                i if i is not None else known[w] if w in known else edged[w] for w, i in zip(words, found, strict=True)
            ]
        return np.frombuffer(b"".join(found), dtype=np.uint32)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per file and Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
