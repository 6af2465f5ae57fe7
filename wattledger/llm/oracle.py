"""SQL counterparts, for DuckDB, of the text queries that SQL can express."""

from __future__ import annotations

from wattledger.llm.mixing import LEAST_WEIGHT, MOST_EPOCHS, SEED, SOURCE_WEIGHTS
from wattledger.llm.quality_rules import CUTOFFS, ERROR, LIMIT
from wattledger.llm.suffix_dedup import LENGTH
from wattledger.llm.token_rollup import TOKENIZERS

WORDS = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
ITEM_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "".join(map(chr, range(65, 91)))


def _n(pattern: str, text: str = "coalesce(text, '')") -> str:
    return f"len(regexp_extract_all({text}, '{pattern}'))"


REPEATS = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, s, substr(h, 2 * s + 1, {2 * LENGTH}) AS k
      FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - {LENGTH - 1})) AS s FROM d)),
hits AS (SELECT doc_id, s FROM (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY k) AS first FROM w)
         WHERE first < doc_id),
marked AS (SELECT *, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + {LENGTH} THEN 0 ELSE 1 END AS new
           FROM hits),
runs AS (SELECT doc_id, min(s) AS a, max(s) + {LENGTH} AS b
         FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM marked) GROUP BY doc_id, run),
gaps AS (SELECT doc_id, b AS a, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS b FROM runs
         UNION ALL SELECT doc_id, 0, min(a) FROM runs GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, length(h) // 2) - a)), '' ORDER BY a) AS k
         FROM gaps JOIN d USING (doc_id) GROUP BY doc_id),
removed AS (SELECT doc_id, sum(b - a) AS n, count(*) AS spans FROM runs GROUP BY doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)"""

ROLLUP = f"""
WITH d AS (SELECT source, lang, {_n(WORDS)} AS words,
                  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id) > 1 AS again,
                  unnest([{", ".join(f"{{'tokenizer': '{t}', 'n': {_n(p)}}}" for t, p in TOKENIZERS.items())}]) AS t
           FROM documents)
SELECT 'all' AS state, source, lang, t.tokenizer AS tokenizer, count(*) AS n_docs, CAST(sum(t.n) AS BIGINT) AS n_tokens
FROM d GROUP BY ALL
UNION ALL
SELECT 'changed', source, lang, t.tokenizer, count(*), CAST(sum(CASE WHEN again THEN 0 ELSE t.n END) AS BIGINT)
FROM d WHERE words >= 5 GROUP BY ALL"""


def _rules() -> str:
    values = {
        "symbols_per_word": "n_symbols / greatest(n_words, 1)",
        "repeated_lines": "n_dup_lines / greatest(n_lines, 1)",
        "repeated_words": "n_repeat_words / greatest(n_words, 1)",
        "word_length": "word_chars / greatest(n_words, 1)",
    }
    cuts = ", ".join(
        f"('{name}', {i}, {c!r}::DOUBLE)" for name, all_cuts in CUTOFFS.items() for i, c in enumerate(all_cuts)
    )
    measured = " UNION ALL ".join(
        f"SELECT doc_id, stratum, '{name}' AS rule, CAST({v} AS DOUBLE) AS v FROM m" for name, v in values.items()
    )
    p = LIMIT / len(CUTOFFS)
    return f"""
WITH split AS (SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text,
                      regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w,
                      [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '{WORDS}')] AS lines
               FROM documents),
windows AS (SELECT doc_id, i, list_aggregate(list_slice(w, i, i + 2), 'string_agg', ' ') AS k
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM split)),
again AS (SELECT doc_id, count(DISTINCT p) AS n
          FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
                FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS c FROM windows) WHERE c > 1)
          GROUP BY doc_id),
m AS (SELECT doc_id, stratum, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST({_n(SYMBOLS, "text")} AS BIGINT) AS n_symbols, len(lines) AS n_lines,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
      FROM split LEFT JOIN again USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
values_of AS ({measured}),
good AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1),
held AS (SELECT v.* FROM values_of v JOIN b USING (doc_id) JOIN good USING (doc_id) WHERE NOT base_failed),
cuts(rule, step, cutoff) AS (VALUES {cuts}),
counted AS (SELECT stratum, rule, step, cutoff, count(*) AS n, count(*) FILTER (v > cutoff) AS k
            FROM held JOIN cuts USING (rule) GROUP BY ALL),
tails AS (SELECT c.*, list_sum([exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({p}) + (n - i) * ln(1 - {p}))
                                FOR i IN range(0, k + 1)]) AS tail,
                 (SELECT count(*) FROM (SELECT DISTINCT stratum, rule FROM held)) AS tests
          FROM (SELECT stratum, rule, step, cutoff, CAST(n AS DOUBLE) AS n, k FROM counted) c),
steps AS (SELECT *, bool_and(tail <= {ERROR} / tests) OVER (PARTITION BY stratum, rule ORDER BY step) AS holds FROM tails),
chosen AS (SELECT stratum, rule, min(cutoff) AS cutoff FROM steps WHERE holds GROUP BY ALL),
over AS (SELECT DISTINCT doc_id FROM values_of JOIN chosen USING (stratum, rule) WHERE v > cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND o.doc_id IS NULL AS kept
FROM b LEFT JOIN over o USING (doc_id)"""


WINDOWS = f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '{ITEM_WORDS}') AS w
              FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
test AS (SELECT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS k
         FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM test),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{ITEM_WORDS}') AS w FROM documents),
spots AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
          FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN sizes)),
hits AS (SELECT doc_id, i, s.n, item_id FROM spots s JOIN test t ON s.n = t.n AND s.k = t.k),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

MIX = f"""
WITH d AS (SELECT doc_id, source, CAST({_n(WORDS)} AS BIGINT) AS size,
                  greatest({LEAST_WEIGHT}::DOUBLE, 1.0::DOUBLE - CAST({_n(SYMBOLS)} AS DOUBLE) / greatest({_n(WORDS)}, 1)) AS weight,
                  (CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5::DOUBLE)
                    / {2**52}::DOUBLE AS u
           FROM documents),
s AS (SELECT source, sum(size) AS source_size, CAST([{", ".join(map(str, SOURCE_WEIGHTS))}][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(SOURCE_WEIGHTS)} + 1 AS BIGINT)] AS DOUBLE) AS w
      FROM d GROUP BY source),
o AS (SELECT *, {MOST_EPOCHS} * source_size / w AS ratio, row_number() OVER (ORDER BY {MOST_EPOCHS} * source_size / w, source NULLS LAST) AS r FROM s),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum({MOST_EPOCHS} * source_size) OVER (ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(w) OVER (ORDER BY r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM o),
t AS (SELECT source, CAST(source_size AS BIGINT) AS source_size,
             least(CAST({MOST_EPOCHS} * source_size AS DOUBLE), w * (SELECT arg_min(level, r) FROM l WHERE ratio >= level)) AS target FROM l),
k AS (SELECT doc_id, size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS epochs,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY -ln(u) / weight, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (epochs + CASE WHEN epochs < {MOST_EPOCHS} AND target > epochs * source_size
                                   AND start + size / 2 <= target - epochs * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM k"""

SQL = {
    "op1_suffix_dedup": REPEATS,
    "op2_token_counts": ROLLUP,
    "op3_quality_rules": _rules(),
    "op7_decontamination": WINDOWS,
    "op10_mixing": MIX,
}
