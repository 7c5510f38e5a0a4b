"""Exact token counts of every prefix of a text, by dynamic programming.

With byte pair encoding the last token of a text's encoding, and the encoding
of what comes before it, are fixed by the text alone: the encoding of a prefix
is a prefix of token lists. So for every prefix exactly one vocabulary token
that ends there continues the encoding of what precedes it, namely the one
that merges with the previous token in the right order. Walking through a text
once gives ``count[i] = count[i - length(token)] + 1`` for all prefixes.

The library splits a text into pieces first, and a prefix may be split in
another way near its end: a run of white space leaves its last character to the
next word, contractions fall apart, special strings are ordinary text until
they are complete. These cases are counted as the library does.

A table holds the differences of the counts of consecutive prefixes: one byte
for the width of an item, then one little-endian item per character. The sum of
the first ``n`` items is the number of tokens of the first ``n`` characters.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tradeloom.llm.common import id_and_text, text_slices
from tradeloom.llm.vocabulary import byte_of_character

MAX_KNOWN = 500_000
MAX_PAIRS = 2_000_000
VECTOR_BYTES = 48  # longer pieces are walked one by one
VECTOR_ROWS = 4096
_TABLE_BITS = 21
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_START = (1 << 20) - 1  # in place of a token: the start of a piece
_WIDTHS = {1: np.dtype("i1"), 2: np.dtype("<i2"), 4: np.dtype("<i4")}
_NEAR = 0x250  # characters below are classed once and split without a proxy
_FAR = re.compile(f"[^\\x00-{chr(_NEAR - 1)}]")
_FALLS_APART = ("'re", "'ve", "'ll")


def _pattern(letters: str, digits: str, spaces: str, together: bool) -> re.Pattern:
    """The library's split for the given character classes.

    With ``together``, white space of two or more characters stays in one match
    with what follows it, since prefixes that end inside it are split otherwise.
    """
    other = f"[^{spaces}{letters}{digits}]+"
    run = f"[{spaces}]{{2,}}(?:[{letters}]+|[{digits}]+|'[^{spaces}]*|{other})|" if together else ""
    return re.compile(
        f"{run}'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{digits}]+| ?{other}|[{spaces}]+(?![^{spaces}])|[{spaces}]+"
    )


# On a proxy, where every character is an ASCII one of its class: letter b,
# digit 0, white space tab, others #. Contractions keep their characters.
_PROXY = ("A-Za-z", "0-9", r" \t\n\x0b\x0c\r")
_PIECE, _JOINED_PIECE = _pattern(*_PROXY, together=False), _pattern(*_PROXY, together=True)


class _Classes(dict):
    """Character classes, asked from the library once per character."""

    def __init__(self, split) -> None:
        super().__init__({i: i for i in range(128)})
        self.split = split
        for i in (*range(9), *range(14, 32), 127):  # control characters are no white space
            self[i] = ord("#")

    def __missing__(self, code: int) -> int:
        char = chr(code)
        for probe, found in (("a", "b"), ("1", "0"), ("!", "#")):
            if len(self.split.pre_tokenize_str(probe + char)) == 1:
                break
        else:
            found = "\t"
        self[code] = ord(found)
        return self[code]


class PrefixCounter:
    """Prefix tables for one byte-level vocabulary file."""

    def __init__(self, path: str, max_known: int = MAX_KNOWN):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split, model = spec.get("pre_tokenizer") or {}, spec["model"]
        if (
            spec.get("normalizer")
            or (split.get("type"), model.get("type")) != ("ByteLevel", "BPE")
            or not split.get("use_regex", True)
            or split.get("add_prefix_space")
            or model.get("ignore_merges")
        ):
            raise ValueError(f"{path} is no plain byte-level BPE vocabulary")
        self.classes = _Classes(Tokenizer.from_file(path).pre_tokenizer)
        self.special = [t["content"] for t in spec.get("added_tokens") or ()]
        for token in spec.get("added_tokens") or ():
            if token["lstrip"] or token["rstrip"] or token["single_word"]:
                raise ValueError(f"special string {token['content']!r} has conditions")
        byte_of = byte_of_character()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ids = {
            bytes(byte_of[c] for c in token): i
            for token, i in model["vocab"].items()
            if token not in self.special and all(c in byte_of for c in token)
        }
        self.bytes_of = {i: b for b, i in self.ids.items()}
        self.rank = {tuple(bytes(byte_of[c] for c in part) for part in pair): r for r, pair in enumerate(pairs)}
        self.longest = max(map(len, self.ids))
        self.max_known = max_known
        self.known: dict[str, bytes | None] = {}
        self.pairs: dict[int, bool] = {}
        self.pair_keys, self.pair_fits = np.zeros(0, np.int64), np.zeros(0, bool)
        self.near = self._near_pattern()
        keys = np.array([_hash(b) for b in self.ids], dtype=np.uint64)
        order = np.argsort(keys)
        self.keys, self.key_ids = keys[order], np.array(list(self.ids.values()), dtype=np.int64)[order]
        self.maybe = np.zeros(1 << _TABLE_BITS, dtype=bool)
        self.maybe[(keys >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = True

    def _near_pattern(self) -> re.Pattern:
        kinds: dict[str, list[str]] = {"b": [], "0": [], "\t": [], " ": []}
        for code in range(_NEAR):
            kind = chr(self.classes[code])
            kind = "b" if kind.isalpha() else "0" if kind.isdigit() else kind if kind in kinds else "\t" * kind.isspace()
            if kind:
                kinds["\t" if kind == " " else kind].append(re.escape(chr(code)))
        return _pattern(*("".join(kinds[k]) for k in "b0\t"), together=True)

    def encode_piece(self, data: bytes) -> list[int]:
        """Plain merging, for short byte strings."""
        parts = [data[i : i + 1] for i in range(len(data))]
        never = len(self.rank)
        while len(parts) > 1:
            ranks = [self.rank.get(pair, never) for pair in zip(parts, parts[1:], strict=False)]
            best = min(ranks)
            if best == never:
                break
            at, merged = 0, []
            while at < len(parts):
                if at < len(ranks) and ranks[at] == best:
                    merged.append(parts[at] + parts[at + 1])
                    at += 2
                else:
                    merged.append(parts[at])
                    at += 1
            parts = merged
        return [self.ids[p] for p in parts]

    def _follows(self, a: int, b: int) -> bool:
        """Whether the two tokens stay apart when their bytes are encoded together."""
        key = a << 20 | b
        found = self.pairs.get(key)
        if found is None:
            if a == _START:  # the token must encode as itself
                found = self.encode_piece(self.bytes_of[b]) == [b]
            else:
                found = self.encode_piece(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
            self.pairs[key] = found
        return found

    def _all_follow(self, keys: np.ndarray) -> np.ndarray:
        """The same for many pairs ``a << 20 | b``."""
        at = np.searchsorted(self.pair_keys, keys)
        at[at == len(self.pair_keys)] = 0
        known = self.pair_keys[at] == keys if len(self.pair_keys) else np.zeros(len(keys), dtype=bool)
        fits = np.zeros(len(keys), dtype=bool)
        fits[known] = self.pair_fits[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            fits[new] = [self._follows(k >> 20, k & _START) for k in keys[new].tolist()]
        return fits

    def _sort_pairs(self) -> None:
        if len(self.pairs) > MAX_PAIRS:
            self.pairs.clear()
        self.pair_keys = np.fromiter(self.pairs, np.int64, len(self.pairs))
        fits = np.fromiter(self.pairs.values(), bool, len(self.pairs))
        order = np.argsort(self.pair_keys)
        self.pair_keys, self.pair_fits = self.pair_keys[order], fits[order]

    def _tokens_at(self, data: np.ndarray) -> list[np.ndarray]:
        """For each length, the token of the bytes from each position; -1 for none."""
        rows, width = data.shape
        hashes = np.zeros((rows, width), dtype=np.uint64)
        out = []
        for length in range(1, min(width, self.longest) + 1):
            hashes = hashes[:, : width - length + 1] * _FACTOR
            hashes += data[:, length - 1 :]
            hashes += np.uint64(1)
            found = np.full(hashes.shape, -1, dtype=np.int64)
            maybe = self.maybe[(hashes >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)]
            wanted = hashes[maybe]
            at = np.searchsorted(self.keys, wanted)
            at[at == len(self.keys)] = 0
            found[maybe] = np.where(self.keys[at] == wanted, self.key_ids[at], -1)
            out.append(found)
        return out

    def _many_counts(self, pieces: list[bytes]) -> np.ndarray:
        """Tokens of every byte prefix of short pieces, one row each; see byte_counts.

        Bytes behind the end of a piece are padding, as are their counts.
        """
        width = max(map(len, pieces))
        data = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)
        tokens = self._tokens_at(data)
        last = np.full((width + 1, len(pieces)), _START, dtype=np.int64)
        count = np.zeros((width + 1, len(pieces)), dtype=np.int32)
        for end in range(1, width + 1):
            open_rows = np.arange(len(pieces))
            for length in range(min(end, len(tokens)), 0, -1):
                start = end - length
                token = tokens[length - 1][open_rows, start]
                rows = open_rows[token >= 0]
                if not len(rows):
                    continue
                token = token[token >= 0]
                fits = self._all_follow(last[start, rows] << 20 | token)
                last[end, rows[fits]] = token[fits]
                count[end, rows[fits]] = count[start, rows[fits]] + 1
                solved = np.zeros(len(pieces), dtype=bool)
                solved[rows[fits]] = True
                open_rows = open_rows[~solved[open_rows]]
                if not len(open_rows):
                    break
        return count

    def _learn(self, pieces: set[str]) -> None:
        """Remember the one-byte differences of pieces, None where they need more."""
        short: list[tuple[str, bytes]] = []
        for piece in pieces:
            data = piece.encode()
            if len(data) > VECTOR_BYTES or piece in _FALLS_APART or (len(piece) > 1 and piece[1].isspace()):
                items = np.diff(np.array(self.plain_counts(piece), dtype=np.int64), prepend=0)
                fits = -128 <= items.min() and items.max() <= 127
                self.known[piece] = items.astype(np.int8).tobytes() if fits else None
            else:
                short.append((piece, data))
        short.sort(key=lambda p: len(p[1]))
        for at in range(0, len(short), VECTOR_ROWS):
            self._learn_short(short[at : at + VECTOR_ROWS])
        self._sort_pairs()

    def _learn_short(self, pieces: list[tuple[str, bytes]]) -> None:
        datas = [d for _, d in pieces]
        counts = self._many_counts(datas)[1:].T
        sizes = np.array([len(d) for d in datas])
        width = counts.shape[1]
        inside = np.arange(width) < sizes[:, None]
        data = np.frombuffer(b"".join(d.ljust(width, b"\0") for d in datas), np.uint8).reshape(-1, width)
        # a character ends where no continuation byte follows
        ends = inside.copy()
        ends[:, :-1] &= ~(inside[:, 1:] & ((data[:, 1:] & 0xC0) == 0x80))
        flat = counts[ends]
        chars = ends.sum(axis=1)
        stops = np.cumsum(chars)
        items = np.diff(flat, prepend=0)
        items[(stops - chars)] = flat[stops - chars]
        joined, at = items.astype(np.int8).tobytes(), 0
        for (piece, _), stop in zip(pieces, stops.tolist(), strict=True):
            self.known[piece] = joined[at:stop]
            at = stop

    def byte_counts(self, data: bytes) -> list[int]:
        """Tokens of every byte prefix of one piece, the empty one first."""
        last, count = [_START], [0]
        for end in range(1, len(data) + 1):
            for start in range(max(0, end - self.longest), end):
                token = self.ids.get(data[start:end])
                if token is not None and self._follows(last[start], token):
                    last.append(token)
                    count.append(count[start] + 1)
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")
        return count

    def _piece_counts(self, piece: str) -> list[int]:
        """Tokens of the first 1, 2, ... characters of a piece."""
        counts = self.byte_counts(piece.encode())
        if not piece.isascii():
            ends = np.cumsum([len(c.encode()) for c in piece])
            counts = [0, *(counts[e] for e in ends.tolist())]
        return counts[1:]

    def plain_counts(self, text: str) -> list[int]:
        """Tokens of the first 1, 2, ... characters, special strings not looked for."""
        proxy = text.translate(self.classes)
        out: list[int] = []
        base = 0
        for match in _PIECE.finditer(proxy):
            start, end = match.span()
            piece = text[start:end]
            counts = self._piece_counts(piece)
            if proxy[start:end] in _FALLS_APART:
                counts[1] = 2  # the apostrophe and a letter on its own
            if proxy[start].isspace() and len(out) == start:
                run_end = end
                while run_end < len(proxy) and proxy[run_end].isspace():
                    run_end += 1
                if run_end - start > 1:  # cut inside the run, it is one piece
                    out += [base + c for c in self._piece_counts(text[start:run_end])]
            # what the run has already answered stays
            out += [base + c for c in counts[max(len(out) - start, 0) :]]
            base += counts[-1]
        return out

    def counts(self, text: str) -> list[int]:
        """Tokens of the first 1, 2, ... characters as the library gives them."""
        out: list[int] = []
        rest = text
        while True:
            base = out[-1] if out else 0
            found = [(at, -len(s), s) for s in self.special if (at := rest.find(s)) >= 0]
            if not found:
                return out + [base + c for c in self.plain_counts(rest)]
            at, _, special = min(found)
            # until it is complete, the special string is ordinary text
            open_counts = self.plain_counts(rest[: at + len(special)])
            before = self.plain_counts(rest[:at])
            out += [base + c for c in open_counts[:-1]] + [base + (before[-1] if before else 0) + 1]
            rest = rest[at + len(special) :]

    def _pieces(self, text: str) -> list[str]:
        if not _FAR.search(text):
            return self.near.findall(text)
        return [text[slice(*m.span())] for m in _JOINED_PIECE.finditer(text.translate(self.classes))]

    def tables(self, texts: list[str]) -> list[tuple[bytes, int]]:
        """The prefix table of each text and its number of tokens."""
        split = [None if any(s in t for s in self.special) else self._pieces(t) for t in texts]
        pieces = {p for s in split if s for p in s}
        new = {p for p in pieces if p not in self.known}
        if len(self.known) + len(new) > self.max_known:
            self.known.clear()
            new = pieces
        if new:
            self._learn(new)
        return [self._table(t, s) for t, s in zip(texts, split, strict=True)]

    def _table(self, text: str, pieces: list[str] | None) -> tuple[bytes, int]:
        if pieces is not None:
            parts = list(map(self.known.__getitem__, pieces))
            if None not in parts:
                data = b"".join(parts)
                return b"\x01" + data, int(np.frombuffer(data, np.int8).sum(dtype=np.int64))
        items = np.diff(np.array(self.counts(text), dtype=np.int64), prepend=0)
        width = next(w for w, k in _WIDTHS.items() if w == 4 or abs(items).max() <= np.iinfo(k).max)
        return bytes([width]) + items.astype(_WIDTHS[width]).tobytes(), int(items.sum())


def _hash(data: bytes) -> int:
    found = 0
    for byte in data:
        found = (found * int(_FACTOR) + byte + 1) % (1 << 64)
    return found


def unpack(table: bytes) -> np.ndarray:
    """Token counts of the prefixes of 0, 1, 2, ... characters."""
    items = np.frombuffer(table, dtype=_WIDTHS[table[0]], offset=1)
    return np.concatenate([[0], np.cumsum(items, dtype=np.int64)])


def longest_within(table: bytes, budget: int) -> int:
    """Characters of the longest prefix that has at most ``budget`` tokens."""
    return int(np.flatnonzero(unpack(table) <= budget)[-1])


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """One counter per file and Python worker."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def prefix_tables(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, n_bytes, n_chars, n_tokens, prefixes)`` per row of ``docs``.

    ``prefixes`` is the table described above; ``n_tokens`` is its last count.
    A NULL text is empty: no tokens and a table of the width only. Repeated
    rows stay, NULL ids too; an empty table gives no rows. Other columns are
    not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = counter(tokenizer)
        for batch in text_slices(batches, "text"):
            tables = found.tables(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("n_bytes"),
                    batch.column("n_chars"),
                    pa.array([n for _, n in tables], pa.int64()),
                    pa.array([t for t, _ in tables], pa.binary()),
                ],
                ["id", "n_bytes", "n_chars", "n_tokens", "prefixes"],
            )

    rows = id_and_text(docs, id_col, text_col).select(
        "id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.length("text").cast("long").alias("n_chars"),
        "text",
    )
    return rows.mapInArrow(run, "id long, n_bytes long, n_chars long, n_tokens long, prefixes binary")


def truncations(tables: DataFrame, budget: int) -> DataFrame:
    """Adds ``chars_within``: characters of the longest prefix within ``budget`` tokens."""
    schema = StructType([*tables.schema.fields, StructField("chars_within", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = [longest_within(t, budget) for t in batch.column("prefixes").to_pylist()]
            arrays = [*batch.columns, pa.array(cut, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, "chars_within"])

    return tables.mapInArrow(run, schema)
