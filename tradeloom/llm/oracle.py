"""Check SQL (DuckDB) of the text queries that SQL can state."""

from __future__ import annotations

from tradeloom.llm import arc_to_warc, host_rules, link_trust

_WORDS = r"[^\x20\x09-\x0D]+"


def archives_sql() -> str:
    return f"""
    WITH payloads AS (
        SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
            sha256(coalesce(html, '')) AS payload_digest
        FROM pages
    ), firsts AS (
        SELECT *, CASE WHEN payload_bytes >= {arc_to_warc.LEAST_REVISIT_BYTES}
            THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first
        FROM payloads
    )
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN first = page_id THEN NULL ELSE first END AS refers_to
    FROM firsts
    """


def host_rules_sql() -> str:
    low, high = host_rules.LEAST_STRENGTH, host_rules.MOST_STRENGTH
    return rf"""
    WITH texts AS (
        SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS text FROM documents
    ), words AS (
        SELECT *, regexp_extract_all(text, '{_WORDS}') AS w FROM texts
    ), windows AS (
        SELECT row, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
        FROM (SELECT row, w, unnest(range(1, len(w) - 1)) AS i FROM words)
    ), covered AS (
        SELECT row, count(DISTINCT p) AS n
        FROM (
            SELECT row, unnest([i, i + 1, i + 2]) AS p
            FROM (SELECT row, i, count(*) OVER (PARTITION BY row, g) AS c FROM windows) WHERE c > 1
        )
        GROUP BY row
    ), stats AS (
        SELECT doc_id, source, len(w)::BIGINT AS n_words,
            coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
            length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
            (len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORDS}')))
             - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORDS}'))))
            )::BIGINT AS n_dup_lines,
            coalesce(n, 0)::BIGINT AS n_repeat_words
        FROM words LEFT JOIN covered USING (row)
    ), judged AS (
        SELECT *, n_words < {host_rules.LEAST_WORDS}
            OR 100 * n_repeat_words > {host_rules.MOST_REPEATED} * n_words AS base_failed
        FROM stats
    ), hosts AS (
        SELECT source, count(*) AS documents, sum(base_failed::INT) AS failures FROM judged GROUP BY source
    ), moments AS (
        SELECT avg(failures / documents) AS m, var_pop(failures / documents) AS v FROM hosts
    ), prior AS (
        SELECT m, least(greatest(CASE WHEN v > 0 THEN m * (1 - m) / v - 1 ELSE {high} END, {low}), {high}) AS s
        FROM moments
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed AND (failures + m * s) / (documents + s) <= {host_rules.MAX_RATE} AS kept
    FROM judged JOIN hosts ON judged.source IS NOT DISTINCT FROM hosts.source, prior
    """


def link_trust_sql(rules: list[link_trust.Rule]) -> str:
    link = link_trust.LINK.replace("'", "''")
    damping, rounds = link_trust.DAMPING, link_trust.ROUNDS
    longest_first = sorted(rules, key=lambda r: (-len(r.text), r.text))

    def case(value: str) -> str:
        whens = "\n".join(
            f"WHEN (host = '{r.host}' OR suffix(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
            f" THEN '{getattr(r, value)}'"
            for r in longest_first
        )
        return f"CASE {whens} END"

    def lower(text: str) -> str:
        return f"translate({text}, '{link_trust.UPPER}', '{link_trust.LOWER}')"

    steps = "".join(
        f""", m{i + 1} AS MATERIALIZED (
        SELECT kind, node, sum(mass) AS mass FROM (
            SELECT kind, "to" AS node, mass * share * {damping} AS mass FROM m{i} JOIN shares USING (kind, node)
            UNION ALL SELECT kind, node, mass * {1 - damping} FROM m0
        ) GROUP BY kind, node
    )"""
        for i in range(rounds)
    )
    return f"""
    WITH parsed AS (
        SELECT page_id, html,
            CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages
    ), placed AS (
        SELECT page_id, html, {lower("regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1)")} AS host,
            regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path
        FROM parsed
    ), ruled AS (
        SELECT page_id, host, path, {case("text")} AS rule, {case("verdict")} AS given FROM placed
    ), links AS MATERIALIZED (
        SELECT DISTINCT src, dst FROM (
            SELECT host AS src, {lower("unnest(regexp_extract_all(html, '" + link + "', 1))")} AS dst FROM placed
        ) WHERE src <> '' AND dst <> src
    ), ways AS (
        SELECT 'trust' AS kind, src AS node, dst AS "to" FROM links
        UNION ALL SELECT 'distrust', dst, src FROM links
    ), shares AS MATERIALIZED (
        SELECT kind, node, "to", 1 / count(*) OVER (PARTITION BY kind, node) AS share FROM ways
    ), seeds AS (
        SELECT DISTINCT CASE WHEN given = 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host AS node
        FROM ruled WHERE given IS NOT NULL AND host <> ''
    ), m0 AS MATERIALIZED (
        SELECT kind, node, 1 / count(*) OVER (PARTITION BY kind) AS mass FROM seeds
    ){steps}, scores AS (
        SELECT node, coalesce(sum(mass) FILTER (WHERE kind = 'trust'), 0) AS trust,
            coalesce(sum(mass) FILTER (WHERE kind = 'distrust'), 0) AS distrust
        FROM m{rounds} GROUP BY node
    )
    SELECT page_id, host, path, rule, coalesce(given,
        CASE WHEN coalesce(distrust, 0) > {link_trust.MAX_DISTRUST} * (coalesce(trust, 0) + coalesce(distrust, 0))
        THEN 'block' ELSE 'allow' END) AS verdict
    FROM ruled LEFT JOIN scores ON ruled.host = scores.node
    """


def lexical_search_sql(top: int = 20) -> str:
    """Scores of all documents that share a term with an item."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    terms = f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{pattern}')"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {terms} AS ts FROM documents),
    lengths AS (SELECT r, doc_id, len(ts) AS n FROM d WHERE len(ts) > 0),
    s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM lengths),
    asked AS (SELECT row_number() OVER () AS i, item_id, {terms} AS ts
              FROM (SELECT DISTINCT item_id, text FROM benchmark)),
    q AS (SELECT i, term, count(*) AS k FROM (SELECT i, unnest(ts) AS term FROM asked) GROUP BY ALL),
    tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM d)
           WHERE term IN (SELECT term FROM q) GROUP BY ALL),
    w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
          FROM tf, s GROUP BY term, docs),
    m AS (SELECT r, doc_id, 100 - 25 + ((25 * n * docs) // words) AS m FROM lengths, s),
    scored AS (
        SELECT i, r, doc_id, CAST(sum(k * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
        FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY ALL),
    ranked AS (
        SELECT i, doc_id, score,
               row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
        FROM scored WHERE score > 0)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked JOIN asked USING (i) WHERE rank <= {top}
    """
