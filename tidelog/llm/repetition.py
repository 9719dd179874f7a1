"""Quality rules on repetition: characters inside duplicated n-grams and lines.

Words get exact numbers per Arrow slice; n-grams are rolling hashes of these numbers, in numpy, over
all texts of a slice at once.  A duplicated n-gram begins with a duplicated shorter one, so each length
only looks at the windows that the length before left over.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidelog.llm.common import appended, boolean, double, long

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
BASE_WINDOW = 8
#: Greatest share of a text's word characters inside duplicated n-grams, by n.
NGRAM_SHARES = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: Greatest shares of lines, and of their characters, that repeat an earlier line.
LINE_SHARE, LINE_CHAR_SHARE = 0.30, 0.20
#: Greatest number of symbols per word.
SYMBOLS_PER_WORD = 0.5
_MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """64 well mixed bits of every 64-bit value."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def covered(numbers: np.ndarray, doc: np.ndarray, lengths: list[int]) -> dict[int, np.ndarray]:
    """For each n: which words lie in an n-gram that its text has twice or more.

    ``numbers`` are word numbers of many texts in a row, ``doc`` the text of each word.
    """
    out = {n: np.zeros(len(numbers), bool) for n in lengths}
    if not len(numbers):
        return out
    codes = mixed(numbers.astype(np.uint64) + _MIX)
    at = np.arange(len(numbers))  # starts of windows that may be duplicated
    rolling, done = np.zeros(len(at), np.uint64), 0
    for n in sorted(lengths):
        inside = at + n <= len(numbers)
        inside[inside] = doc[at[inside]] == doc[at[inside] + n - 1]
        at, rolling = at[inside], rolling[inside]
        for i in range(done, n):
            rolling = rolling * np.uint64(0x5851F42D4C957F2D) + codes[at + i]
        done = n
        keys = mixed(rolling ^ mixed(doc[at].astype(np.uint64) + _MIX))
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        at, rolling = at[twice], rolling[twice]
        edge = np.zeros(len(numbers) + 1, np.int64)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + n, -1)
        out[n] = np.cumsum(edge)[:-1] > 0
    return out


def measured(texts: list[str]) -> dict[str, np.ndarray]:
    """Counts of every text: words, characters, symbols, duplicated lines and n-grams."""
    raw = [t.encode() for t in texts]
    split = [r.split() for r in raw]  # at the six ASCII spaces
    n_words = np.array([len(w) for w in split], np.int64)
    doc = np.repeat(np.arange(len(texts)), n_words)
    coded = pa.array([w for ws in split for w in ws], pa.binary()).dictionary_encode()
    numbers = coded.indices.to_numpy().astype(np.int64)
    chars = np.array([len(w.decode()) for w in coded.dictionary.to_pylist()], np.int64)
    chars = chars[numbers] if len(numbers) else np.zeros(0, np.int64)

    def per_text(values):
        return np.bincount(doc, values, len(texts)).astype(np.int64) if len(doc) else np.zeros(len(texts), np.int64)

    out = {"n_words": n_words, "word_chars": per_text(chars)}
    out["n_symbols"] = np.array([len(r) - len(r.translate(None, SYMBOLS)) for r in raw], np.int64)
    lines = [[line for line in r.split(b"\n") if line.strip(SPACES)] for r in raw]
    out["n_lines"] = np.array(list(map(len, lines)), np.int64)
    out["n_dup_lines"] = np.array([len(x) - len(set(x)) for x in lines], np.int64)
    out["line_chars"] = np.array([sum(map(len, x)) for x in lines], np.int64)
    out["dup_line_chars"] = out["line_chars"] - np.array([sum(map(len, set(x))) for x in lines], np.int64)
    inside = covered(numbers, doc, sorted({*NGRAM_SHARES, BASE_WINDOW}))
    out["n_repeat_words"] = per_text(inside[BASE_WINDOW])
    for n in NGRAM_SHARES:
        out[f"chars_{n}"] = per_text(np.where(inside[n], chars, 0))
    return out


def verdicts(m: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Which texts fail the base rule, and which are kept."""
    failed = (m["n_words"] < 20) | (100 * m["n_repeat_words"] > 30 * m["n_words"])
    kept = ~failed & (m["n_symbols"] <= SYMBOLS_PER_WORD * m["n_words"])
    kept &= m["n_dup_lines"] <= LINE_SHARE * m["n_lines"]
    kept &= m["dup_line_chars"] <= LINE_CHAR_SHARE * m["line_chars"]
    for n, share in NGRAM_SHARES.items():
        kept &= m[f"chars_{n}"] <= share * m["word_chars"]
    return failed, kept


def _start():
    def work(texts):
        m = measured([t or "" for t in texts])
        failed, kept = verdicts(m)
        worst = np.max([m[f"chars_{n}"] for n in NGRAM_SHARES], axis=0) / np.maximum(m["word_chars"], 1)
        counts = [m[c].tolist() for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
        return [*counts, failed.tolist(), kept.tolist(), worst.tolist()]

    return work


def repeated(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The counts of every whole text, whether it fails the base rule, and whether it is kept.

    A null or empty text has no words and fails.  Texts may be of any length; a text is measured on its
    own, so equal rows give equal rows.  ``keep`` names the columns that come along (all by default); one
    named like a result is replaced.
    """
    results = [long(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    results += [boolean("base_failed"), boolean("kept"), double("ngram_share")]
    return appended(docs, [text_col], docs.columns if keep is None else keep, results, partial(_start))


def oracle() -> str:
    """The same results for DuckDB: n-grams are texts of words joined by a space, which no word holds."""
    lengths = sorted({*NGRAM_SHARES, BASE_WINDOW})
    tail = {n: f"lead(w, {n - 1}) OVER o" for n in lengths}
    grams = ", ".join(f"CASE WHEN {tail[n]} IS NOT NULL THEN concat_ws(' ', w, "
                      + ", ".join(f"lead(w, {k}) OVER o" for k in range(1, n)) + f") END AS g{n}" for n in lengths)
    twice = ", ".join(f"g{n} IS NOT NULL AND count(*) OVER (PARTITION BY r, g{n}) > 1 AS t{n}" for n in lengths)
    inside = ", ".join(f"bool_or(t{n}) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS i{n}"
                       for n in lengths)
    chars = ", ".join(f"coalesce(sum(c) FILTER (i{n}), 0) AS chars_{n}" for n in NGRAM_SHARES)
    most = ", ".join(f"chars_{n}" for n in NGRAM_SHARES)
    rules = " AND ".join([f"n_symbols <= CAST({SYMBOLS_PER_WORD} AS DOUBLE) * n_words",
                          f"n_dup_lines <= CAST({LINE_SHARE} AS DOUBLE) * n_lines",
                          f"dup_line_chars <= CAST({LINE_CHAR_SHARE} AS DOUBLE) * line_chars",
                          *[f"chars_{n} <= CAST({s} AS DOUBLE) * word_chars" for n, s in NGRAM_SHARES.items()]])
    return rf"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
split AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM texts),
words AS (SELECT r, unnest(ws) AS w, unnest(range(len(ws))) AS p FROM split),
grams AS (SELECT r, p, length(w) AS c, {grams} FROM words WINDOW o AS (PARTITION BY r ORDER BY p)),
twice AS (SELECT r, p, c, {twice} FROM grams),
inside AS (SELECT r, c, {inside} FROM twice),
sums AS (SELECT r, count(*) AS n_words, sum(c) AS word_chars, count(*) FILTER (i{BASE_WINDOW}) AS n_repeat_words, {chars}
  FROM inside GROUP BY r),
measured AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
  length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) AS n_lines,
  len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(list_sum(list_transform(ls, lambda x: strlen(x))), 0) AS line_chars,
  coalesce(list_sum(list_transform(ls, lambda x: strlen(x))), 0)
    - coalesce(list_sum(list_transform(list_distinct(ls), lambda x: strlen(x))), 0) AS dup_line_chars,
  coalesce(n_repeat_words, 0) AS n_repeat_words, {", ".join(f"coalesce(chars_{n}, 0) AS chars_{n}" for n in NGRAM_SHARES)}
  FROM texts JOIN split USING (r) LEFT JOIN sums USING (r)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {rules} AS kept,
  CAST(greatest({most}) AS DOUBLE) / greatest(word_chars, 1) AS ngram_share FROM judged"""
