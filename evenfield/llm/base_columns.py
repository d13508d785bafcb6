"""The columns of operators 3, 6, 7, 9, 11 and 12 that SQL can express, each beside its DuckDB SQL, and the SQL of operator 13.

The queries take the operators' own rows and leave out what a model or a template decides, so the SQL checks the counts,
spans and digests of every whole text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat_format import op9_chat_format
from .common import read_table
from .embedding_whitening import op12_embedding_whitening
from .lm_score import score_texts
from .quality import op6_quality_rules
from .secrets import op3_secret_scan
from .substring_dedup import digests

WORD = r"[^\x20\x09-\x0D]+"
# a document's row number stands for it, as two rows may share a doc_id
DOCS = "d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents)"


def _either_case(text: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in text)


_NAMES = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token")) + f"|{_either_case('api')}_?{_either_case('key')}"
_VALUE = "[A-Za-z0-9+/_.=-]+"
_ASSIGN = rf"({_NAMES})[\"\x27]?\x20*[:=]\x20*[\"\x27]?({_VALUE})"

# A match's text occurs for the first time after the match before it where the match itself is: the pattern would match at
# any earlier place, too. Assignments that fail still move the place where the next one is looked for; the other two kinds
# match whole runs, so their least lengths can stand in the pattern.
SECRETS = rf"""WITH RECURSIVE {DOCS},
  m AS MATERIALIZED (SELECT r, 0 AS kind, regexp_extract_all(t, '{_ASSIGN}') AS found, regexp_extract_all(t, '{_ASSIGN}', 2) AS inner_ FROM d
    UNION ALL SELECT r, 1, regexp_extract_all(t, 'AKIA[A-Z0-9]{{16,}}') AS f, f FROM d UNION ALL SELECT r, 2, regexp_extract_all(t, '[0-9a-f]{{24,}}') AS f, f FROM d),
  s AS (SELECT r, kind, 0 AS k, 0 AS start, 0 AS stop FROM m
    UNION ALL SELECT r, kind, k + 1, stop + strpos(substr(t, stop + 1), found[k + 1]) - 1, stop + strpos(substr(t, stop + 1), found[k + 1]) - 1 + length(found[k + 1]) FROM s JOIN m USING (r, kind) JOIN d USING (r) WHERE k < len(found)),
  good AS (SELECT r, kind, start, stop FROM s JOIN m USING (r, kind) WHERE k > 0 AND length(inner_[k]) >= [6, 20, 24][kind + 1])
SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
  sha256(coalesce(string_agg(['assign', 'access', 'hex'][kind + 1] || ':' || start || ':' || stop, ',' ORDER BY start, kind), '')) AS base_sha256 FROM d LEFT JOIN good USING (r) GROUP BY r, doc_id"""

QUALITY = rf"""WITH {DOCS}, w AS MATERIALIZED (SELECT r, doc_id, t, regexp_extract_all(t, '{WORD}') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls FROM d),
  g AS (SELECT r, i, array_to_string(ws[i:i + 4], ' ') AS five FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) > 4)),
  twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, five) AS n FROM g) WHERE n > 1),
  again AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(5)) AS k) GROUP BY r),
  c AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars, CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words FROM w LEFT JOIN again USING (r))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c"""

# the remainder of the reflected CRC-32, bit by bit; -1 stands for a shift
CRC = "xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295::BIGINT)"
UNIGRAMS = rf"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {CRC} % 5 = 1 AS held_out, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
  k AS (SELECT r, held_out, unnest(list_concat(regexp_extract_all(t, '{WORD}'), [' end'])) AS token FROM d),
  c AS (SELECT token, count(*) AS c FROM k WHERE NOT held_out GROUP BY token), n AS (SELECT coalesce(sum(c), 0) AS n, count(*) AS v FROM c)
SELECT doc_id, d.held_out, count(*) AS n_tokens, count(c) AS n_known, CAST(any_value(n) AS BIGINT) AS train_tokens, round(sum(log10((coalesce(c, 0) + 0.5) / (n + 0.5 * (v + 1)))), 4) AS base_score FROM d JOIN k USING (r) LEFT JOIN c USING (token), n GROUP BY d.r, doc_id, d.held_out"""

CHATS = """WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS t FROM conversations UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn)) AS turns_sha256, CAST(coalesce(sum(length(t)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256 FROM c GROUP BY conv_id"""


REPEATS = rf"""WITH {DOCS}, w AS MATERIALIZED (SELECT r, doc_id, regexp_extract_all(t, '{WORD}') AS ws FROM d),
  g AS (SELECT r, doc_id, i, array_to_string(ws[i:i + 19], ' ') AS key FROM (SELECT r, doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20)),
  later AS (SELECT r, i FROM (SELECT r, i, row_number() OVER (PARTITION BY key ORDER BY doc_id, r, i) AS k FROM g) WHERE k > 1),
  gone AS (SELECT DISTINCT r, i + k AS i FROM later, (SELECT unnest(range(20)) AS k)),
  each AS (SELECT r, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM w),
  kept AS (SELECT each.r, count(gone.i) AS n_removed, string_agg(word, ' ' ORDER BY each.i) FILTER (gone.i IS NULL) AS t FROM each LEFT JOIN gone ON gone.r = each.r AND gone.i = each.i GROUP BY each.r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (r)"""

DEVIATIONS = """WITH e AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
  f AS (SELECT DISTINCT x FROM e), n AS (SELECT count(*) AS n FROM f), s AS (SELECT i, sum(v) AS s FROM (SELECT unnest(x) AS v, generate_subscripts(x, 1) AS i FROM f) GROUP BY i),
  each AS (SELECT r, vec_id, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM e)
SELECT vec_id, any_value(n) AS n, CAST(sum((n * v - s) * (n * v - s)) AS BIGINT) AS deviation FROM each JOIN s USING (i), n GROUP BY r, vec_id"""

# a forward search: of each state the cheapest edits so far, of equal ones the first in ASCII, a row of the conversation a step
_KEY = "lpad(CAST({0} AS VARCHAR), 9, '0') || {1}"
_BEST = ", ".join(f"min_by({c}, {_KEY.format('cost', 'audit')}) AS {c}" for c in ("cost", "audit", "out"))
REPAIRS = rf"""WITH RECURSIVE src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {CRC.replace("CAST(doc_id AS VARCHAR)", "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind FROM conversations),
  d AS (SELECT conv_id, turn, copy, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE WHEN kind <= 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text FROM src, (VALUES (0), (1)) AS c(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
  o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, copy) AS k, regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) AS last, left(role, 1) AS i FROM d),
  f AS MATERIALIZED (SELECT *, CASE WHEN last = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    k > 1 AND lag(i) OVER (PARTITION BY conv_id ORDER BY k) || i NOT IN ('su', 'ua', 'au') AS illegal FROM o),
  ins(was, now, n, added) AS (VALUES ('', '', 0, []::VARCHAR[]), ('s', 's', 0, []), ('u', 'u', 0, []), ('a', 'a', 0, []), ('', 'u', 1, ['user:']), ('s', 'u', 1, ['user:']), ('a', 'u', 1, ['user:']), ('u', 'a', 1, ['assistant:']),
    ('', 'a', 2, ['user:', 'assistant:']), ('s', 'a', 2, ['user:', 'assistant:']), ('a', 'a', 2, ['user:', 'assistant:']), ('u', 'u', 2, ['assistant:', 'user:'])),
  s AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS k, '' AS state, 0 AS cost, '' AS audit, []::VARCHAR[] AS out FROM f
    UNION ALL SELECT conv_id, k, state, {_BEST} FROM (
      SELECT f.conv_id, f.k, CASE e WHEN 'D' THEN now WHEN 'K' THEN f.i ELSE next END AS state, s.cost + 5 * n + CASE e WHEN 'D' THEN 2 WHEN 'K' THEN 0 ELSE 1 END + CASE WHEN e <> 'D' AND fault = 'truncated' THEN 5 ELSE 0 END AS cost,
        s.audit || repeat('I', n) || e AS audit, list_concat(s.out, added, CASE e WHEN 'D' THEN [] WHEN 'K' THEN [f.role || ':' || f.text] ELSE [CASE next WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || f.text] END) AS out
      FROM s JOIN f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.k = s.k + 1 JOIN (SELECT *, CASE now WHEN 'u' THEN 'a' ELSE 'u' END AS next FROM ins) j ON was = s.state, (VALUES ('D'), ('K'), ('R')) AS v(e)
      WHERE e = 'D' OR (fault NOT IN ('blank', 'duplicate') AND (e = 'R' OR f.i = next OR (now = '' AND f.i = 's')))) GROUP BY conv_id, k, state),
  done AS (SELECT conv_id, {_BEST} FROM (SELECT s.conv_id, s.cost + 5 * n AS cost, s.audit || repeat('I', n) AS audit, list_concat(s.out, added) AS out FROM s JOIN ins ON was = s.state
    JOIN (SELECT conv_id, max(k) AS k FROM f GROUP BY conv_id) m ON m.conv_id IS NOT DISTINCT FROM s.conv_id AND m.k = s.k WHERE now IN ('', 'a')) GROUP BY conv_id),
  c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal FROM f GROUP BY conv_id)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(out, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM src) a LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM a.conv_id"""


def base3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_secret_scan(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


def base6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_quality_rules(spark, sf_dir).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def base7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(read_table(spark, sf_dir, "documents"), with_model=False).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 4).alias("base_score"))


def base9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_chat_format(spark, sf_dir).select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")


def base11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read_table(spark, sf_dir, "documents"), longest=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


def base12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_embedding_whitening(spark, sf_dir).filter("component = 1").select("vec_id", "n", "deviation")


QUERIES = (base3_secret_scan, base6_quality_rules, base7_lm_score, base9_chat_format, base11_substring_dedup, base12_embedding_whitening)
SQL = {"base3_secret_scan": SECRETS, "base6_quality_rules": QUALITY, "base7_lm_score": UNIGRAMS, "base9_chat_format": CHATS, "base11_substring_dedup": REPEATS, "base12_embedding_whitening": DEVIATIONS}
