"""Operator 1, line dedup by a log-template tree, in DataFrame functions only.

A line is parsed by a tree of fixed depth. Tokens with a digit or an ``@`` (numbers, dates, ids, addresses) become
``<*>`` first. The line then descends by its token count and its first ``LEADING`` tokens to a branch. Over the distinct
lines of a branch, a position is constant if one token holds at least ``DOMINANT`` percent of them, else it varies. A branch of two
lines or more in which at least ``CONSTANT`` percent of the positions are constant (leading tokens counted) has a template: its constant tokens, with ``<*>`` for the others. Lines that
agree with all constant tokens share that leaf; every other line, and every line under ``MIN_TOKENS`` tokens, is a leaf of its own (its masked text).
The branch statistics take all lines of all documents, so the result does not depend on the order of rows.

A template that occurs in ``min_docs`` or more documents (two at least) recurs: only the document with the smallest id keeps its
lines, in all others they are dropped, in order and wholly.

Scale: texts are parsed once to 64-bit names, written to the shared folder. A name is one row with its smallest and largest
id and a count after a map-side combine, so a boilerplate line in a third of all documents is one row per task. The texts of a
branch of two distinct lines or more are read once more; the names of these branches are broadcast if they are few, else lines meet them by a shuffle.
Only lines that follow a template are joined with the keeper of their leaf. Statistics are counts per (branch, position, token), combined before their shuffle. A template is joined back to the
distinct lines of its branch salted by line, and the names that a
document loses to the documents salted by document. They return as line numbers, so that cutting a text takes time in its length.

Defined cases: lines end at ``\\n``; tokens are split at single spaces; blank lines are no templates and stay; null text stays null, and
empty text empty; rows with equal ``doc_id`` never make a template recur by themselves, but each distinct masked line of each row counts
towards a ``min_docs`` above two; a null ``doc_id`` counts as smaller
than any; a template's repeats within its first document stay; other columns are ignored.
"""

from __future__ import annotations

import uuid

from llm.shared import shared_path
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEADING = 3
MIN_TOKENS = 6
DOMINANT = 80
CONSTANT = 60
VARIABLE = r"[^ \t\r]*[0-9@][^ \t\r]*"
PLACEHOLDER = "<*>"
SALTS = 16
#: So many branch names (16 MiB) may be broadcast; beyond that the lines are shuffled to them.
BROADCAST = 1 << 21
MIN_DOCS = 2
_NULL_ID = -(1 << 63)


def masked(line: Column) -> Column:
    """The line with its typed fields masked; null for a blank line."""
    text = F.when(line.rlike("[0-9@]"), F.regexp_replace(line, VARIABLE, PLACEHOLDER)).otherwise(line)
    return F.when(F.trim(line, F.lit(" \t\r")) != "", text)


def _tokens(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "))) + 1


def _salts() -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))


def _salt(key: str) -> Column:
    return F.pmod(F.col(key), F.lit(SALTS)).cast("int")


def templates(lines: DataFrame) -> DataFrame:
    """(branch, salt, constants): the template of each branch that has one, from distinct ``lines (branch, n_tokens, text)``.

    ``constants`` holds (position, token) of the constant tokens after the leading ones.
    """
    size = lines.groupBy("branch").agg(F.count("*").alias("n_lines"), F.first("n_tokens").alias("n_tokens")).where("n_lines > 1")
    tokens = lines.select("branch", F.posexplode(F.split("text", " ")).alias("position", "token")).where(F.col("position") >= LEADING)
    held = tokens.groupBy("branch", "position", "token").agg(F.count("*").alias("n"))
    top = held.groupBy("branch", "position").agg(F.max(F.struct("n", "token")).alias("top"))
    constant = top.join(size, "branch").where(F.col("top.n") * 100 >= F.col("n_lines") * DOMINANT)
    found = constant.groupBy("branch", "n_tokens").agg(F.collect_list(F.struct("position", F.col("top.token").alias("token"))).alias("constants"))
    kept = found.where((F.size("constants") + LEADING) * 100 >= F.col("n_tokens") * CONSTANT)
    return kept.select("branch", "constants", _salts().alias("salt"))


def followers(lines: DataFrame) -> DataFrame:
    """(line, leaf): those of the distinct ``lines (line, branch, n_tokens, text)`` that agree with the template of their branch."""
    joined = lines.withColumn("salt", _salt("line")).join(templates(lines), ["branch", "salt"])
    tokens = F.split("text", " ")
    agrees = F.forall("constants", lambda c: F.get(tokens, c["position"]) == c["token"])
    return joined.where(agrees).select("line", F.xxhash64(F.lit("template"), "branch").alias("leaf"))


def _parsed(line: Column) -> Column:
    """(line, branch, n_tokens) of a masked line: its name, and its branch if it has ``MIN_TOKENS``."""
    n = _tokens(line)
    branch = F.when(n >= MIN_TOKENS, F.xxhash64(n, F.substring_index(line, " ", LEADING)))
    return F.when(line.isNotNull(), F.struct(F.xxhash64(line).alias("line"), branch.alias("branch"), n.alias("n_tokens")))


def drop_recurring(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, key: Column | None = None) -> DataFrame:
    """Per row: ``doc_id, n_lines, n_dropped, text`` (the remaining lines), ``row`` (the other input columns); ``key`` (long) tells documents apart, by default the id."""
    spark = docs.sparkSession
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)) if key is None else key
    rows = docs.select(F.col(id_col).alias("doc_id"), key.alias("_key"), F.col(text_col).cast("string").alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col] or [F.lit(0).alias("none")]).alias("row"))
    rows = rows.withColumn("_text", F.xxhash64("text"))
    base = shared_path(spark, f"line-templates/{uuid.uuid4().hex}")

    def written(name: str, table: DataFrame) -> DataFrame:
        table.write.parquet(f"{base}/{name}")
        return spark.read.schema(table.schema).parquet(f"{base}/{name}")

    masks = F.transform(F.split("text", "\n"), masked)
    parsed = written("parsed", rows.where("text is not null").select("_key", "_text", F.transform(masks, _parsed).alias("lines")))
    named = parsed.select("_key", F.explode(F.array_distinct("lines.line")).alias("line")).where("line is not null")
    lively = parsed.select(F.explode("lines").alias("l")).select("l.*").where("branch is not null").groupBy("branch").agg(F.min("line").alias("a"), F.max("line").alias("b")).where("a <> b")
    lively = written("branches", lively.select("branch"))
    small = lively.limit(BROADCAST + 1).count() <= BROADCAST
    texts = rows.select(F.explode(F.array_distinct(masks)).alias("text")).select("text", _parsed(F.col("text")).alias("l")).select("l.*", "text")
    inside = texts.where("branch is not null").join(F.broadcast(lively) if small else lively, "branch", "left_semi")
    following = written("following", followers(written("inside", inside.select("line", "branch", "n_tokens", "text").distinct())))

    once = named.groupBy("line").agg(F.min("_key").alias("first"), F.max("_key").alias("last"), F.count("*").alias("n"))
    once = written("once", once.join(following, "line", "left"))
    recurring = (F.col("first") != F.col("last")) & (F.col("n") >= min_docs)
    alone = once.where(F.col("leaf").isNull() & recurring).select("line", F.col("first").alias("keeper"))
    merged = once.where("leaf is not null")
    recurs = merged.groupBy("leaf").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n")).where(recurring)
    spread = recurs.select("leaf", F.col("first").alias("keeper"), _salts().alias("salt"))
    shared = alone.unionByName(merged.withColumn("salt", _salt("line")).join(spread, ["leaf", "salt"]).select("line", "keeper"))

    numbered = parsed.select("_key", "_text", F.posexplode("lines.line").alias("at", "line")).where("line is not null")
    spread = shared.select("line", "keeper", _salts().alias("salt"))
    lost = numbered.withColumn("salt", _salt("_key")).join(spread, ["line", "salt"]).where("_key <> keeper").groupBy("_key", "_text").agg(F.collect_set("at").alias("lost"))

    joined = rows.join(lost, ["_key", "_text"], "left")
    lines = F.split("text", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("lost"))
    stay = F.when(F.col("lost").isNull(), lines).otherwise(F.transform(kept, lambda at: F.get(F.col("lines"), at)))
    cut = joined.withColumn("lines", lines).select("doc_id", "row", "text", "lines", stay.alias("stay"))
    size = F.coalesce(F.size("lines"), F.lit(0)).cast("long")
    return cut.select(
        "doc_id",
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(size).cast("long").alias("n_lines"),
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size("lines") - F.size("stay")).cast("long").alias("n_dropped"),
        F.array_join("stay", "\n").alias("text"),
        "row",
    )


def op1_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``documents`` table."""
    return drop_recurring(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_lines", "n_dropped", "text")


OP1_SQL = f"""
WITH lines AS (
  SELECT d.doc_id, u.k, list_extract(string_split(d.text, chr(10)), u.k) AS line
  FROM documents d, LATERAL (SELECT unnest(range(1, len(string_split(d.text, chr(10))) + 1)) AS k) u),
named AS (
  SELECT *, CASE WHEN trim(line, ' ' || chr(9) || chr(13)) = '' THEN NULL
                 ELSE regexp_replace(line, '{VARIABLE}', '{PLACEHOLDER}', 'g') END AS masked FROM lines),
parsed AS (
  SELECT masked, string_split(masked, ' ') AS tokens FROM (SELECT DISTINCT masked FROM named WHERE masked IS NOT NULL)),
deep AS (
  SELECT masked, tokens, len(tokens) AS n_tokens, tokens[1:{LEADING}] AS head FROM parsed WHERE len(tokens) >= {MIN_TOKENS}),
branches AS (SELECT n_tokens, head, count(*) AS n_lines FROM deep GROUP BY ALL HAVING count(*) > 1),
places AS (
  SELECT n_tokens, head, n_lines, masked, unnest(range({LEADING + 1}, n_tokens + 1)) AS place, unnest(tokens[{LEADING + 1}:]) AS token
  FROM deep JOIN branches USING (n_tokens, head)),
constants AS (
  SELECT n_tokens, head, place, token FROM places GROUP BY n_tokens, head, n_lines, place, token HAVING 100 * count(*) >= {DOMINANT} * n_lines),
patterns AS (
  SELECT n_tokens, head, count(*) AS n_constant FROM constants
  GROUP BY n_tokens, head HAVING 100 * (count(*) + {LEADING}) >= {CONSTANT} * n_tokens),
followers AS (
  SELECT masked, n_tokens, head FROM places JOIN patterns USING (n_tokens, head) JOIN constants USING (n_tokens, head, place, token)
  GROUP BY masked, n_tokens, head, n_constant HAVING count(*) = n_constant),
leaf AS (
  SELECT p.masked, CASE WHEN f.masked IS NULL THEN 'line ' || p.masked
                        ELSE 'template ' || f.n_tokens || ' ' || array_to_string(f.head, ' ') END AS leaf
  FROM parsed p LEFT JOIN followers f USING (masked)),
shared AS (
  SELECT leaf, min(doc_id) AS first FROM named JOIN leaf USING (masked) GROUP BY leaf HAVING min(doc_id) <> max(doc_id)),
marked AS (
  SELECT n.*, s.first IS NOT NULL AND s.first <> n.doc_id AS gone
  FROM named n LEFT JOIN leaf USING (masked) LEFT JOIN shared s USING (leaf))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT gone), '') AS text
FROM marked GROUP BY doc_id
"""
