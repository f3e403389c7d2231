"""Query of the conversation repair, on conversations damaged by a rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbre.llm.conversations import repair
from lumbre.llm.query_shards import _crc_table
from lumbre.sources.tables import scan

#: One of so many turns gets each damage.
DAMAGES = 20


def damaged(rows: DataFrame) -> DataFrame:
    """Rows by the checksum of ``conv_id:turn``: 0 dropped, 1 emptied, 2 without closing marks, 3 twice, 4 from the user.

    Dropped rows stay with ``copies`` 0, so that their conversation is known.
    """
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(name.cast("binary")) % DAMAGES
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    changed = F.when(kind.isin(0, 1), "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        changed.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and repaired text of every damaged conversation."""
    return repair(damaged(scan(spark, sf_dir, "conversations")), copies_col="copies")


_BYTES = "list_transform(regexp_extract_all(hex(encode({})), '..'), lambda x: ('0x' || x)::BIGINT)"
_NAME = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
_CRC = f"""xor(list_reduce(list_prepend(4294967295::BIGINT, {_BYTES.format(_NAME)}),
       lambda c, x: xor(c >> 8, ({_crc_table()}::BIGINT[])[(xor(c, x) & 255) + 1])), 4294967295)"""


def _best(*options: str) -> str:
    """The least of some (cost, audit, lines) values."""
    return f"list_min([{', '.join(options)}])"


def _then(cost: str, letter: str, line: str | None, rest: str) -> str:
    """A letter before the best way from the next state on."""
    lines = f"list_prepend({line}, {rest}.t)" if line else f"{rest}.t"
    return f"{{'c': {cost} + {rest}.c, 'a': '{letter}' || {rest}.a, 't': {lines}}}"


def _consumed(state: int, due: str, after: int, kept: str) -> str:
    """The best way from a state that begins with the row: delete, keep or give the due role."""
    keep = f"CASE WHEN {kept} THEN " + _then("truncated", "K", "role || ':' || text", f"v{{}}") + " END"
    kept_after = {0: "CASE initial WHEN 's' THEN v1 ELSE v2 END", 1: "v2", 2: "v3", 3: "v2"}[state]
    keep = keep.replace("v{}", f"({kept_after})")
    return _best(
        _then("3", "D", None, f"v{state}"),
        f"CASE WHEN NOT gone THEN {_then('2 + truncated', 'R', f"'{due}:' || text", f'v{after}')} END",
        f"CASE WHEN NOT gone THEN {keep} END",
    )


_DONE = "{'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]}"
_OPEN = "{'c': 2::BIGINT, 'a': 'I', 't': ['assistant:']}"
_PAIR = "{'c': 4::BIGINT, 'a': 'II', 't': ['user:', 'assistant:']}"

SQL = {
    "op12_conversations": f"""
WITH RECURSIVE hit AS (
  SELECT dense_rank() OVER (ORDER BY conv_id) AS k, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_CRC} % {DAMAGES} AS kind FROM conversations),
bad AS (
  SELECT k, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM hit WHERE kind <> 0),
seen AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, text, copy) AS i, left(role, 1) AS initial FROM bad),
judged AS (
  SELECT *, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank,
         row_number() OVER (PARTITION BY k, role, text ORDER BY i) > 1 AS again,
         regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) NOT IN ('.', '!', '?') AS open,
         lag(initial) OVER (PARTITION BY k ORDER BY i) || initial AS pair FROM seen),
faults AS (
  SELECT *, blank OR again AS gone, CAST(NOT blank AND NOT again AND open AS INT) AS truncated FROM judged),
sums AS (
  SELECT k, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE NOT blank AND again) AS duplicate,
         sum(truncated) AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY k),
way AS (
  SELECT k, n AS i, {_DONE} AS v0, {_PAIR} AS v1, {_OPEN} AS v2, {_DONE} AS v3 FROM sums
  UNION ALL
  SELECT k, i, {_best("x0", _then("2", "I", "'user:'", "y2"))}, {_best("x1", _then("2", "I", "'user:'", "y2"))}, y2, y3
  FROM (SELECT *, {_best("x2", _then("2", "I", "'assistant:'", "x3"))} AS y2, {_best("x3", _then("2", "I", "'user:'", "x2"))} AS y3
  FROM (SELECT way.k, way.i - 1 AS i,
      {_consumed(0, "user", 2, "initial IN ('s', 'u')")} AS x0, {_consumed(1, "user", 2, "initial = 'u'")} AS x1,
      {_consumed(2, "assistant", 3, "initial = 'a'")} AS x2, {_consumed(3, "user", 2, "initial = 'u'")} AS x3
    FROM way JOIN faults ON faults.k = way.k AND faults.i = way.i WHERE way.i > 0))),
best AS (SELECT k, v0 FROM way WHERE i = 0)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(v0.c, 0) AS cost,
       coalesce(v0.a, '') AS audit, sha256(coalesce(array_to_string(v0.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT k, conv_id FROM hit) AS h LEFT JOIN sums ON sums.k = h.k LEFT JOIN best ON best.k = h.k"""
}
QUERIES = {"op12_conversations": op12_conversations}
