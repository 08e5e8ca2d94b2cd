"""Operator 4, benchmark decontamination by template canonicalisation, in DataFrame functions only.

Texts and benchmark items are canonicalised token by token: numbers, names (a capitalised word inside
a sentence) and units (after a number) become typed placeholders, the rest lower case. A re-parameterised
question keeps its template.

1. *Anchors.* Every run of ``WINDOW`` tokens of the items is indexed by hash. Of each document only
   every ``step``-th window is looked up (``step`` at most ``WINDOW``, less if an item is short), which
   any copied stretch of ``step + WINDOW - 1`` tokens must meet. Documents without a hit are done.
2. *Windows.* All windows of the documents with a hit are joined by hash with the items' windows.
3. *Slots.* Where both sides of a window hold placeholders, the item's values and the document's are
   paired; a value that stands for several others in the same occurrence is inconsistent.

An occurrence is the windows of one aligned offset (place in the document less place in the item), those of
a run of near offsets (words were put in or left out), or all of the document. An item contaminates a document
if, in one occurrence, at least ``SIMILARITY`` of its windows are found and at least as large a share of its slot
values is consistent. A document that holds a frequent window costs three rows per
window found; no pairs of documents arise. The index is broadcast only below ``MAX_BROADCAST`` windows,
by count; beyond that the joins shuffle.

Defined cases: null and empty texts or items have no tokens and no match; items with fewer tokens than
a window cannot match; repeated rows count once per id; rows with a null id are matched under a null id;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WINDOW = 5
SIMILARITY = 0.8
MAX_BROADCAST = 1_000_000
#: Fixed list: unit words and symbols that may follow a number.
UNITS = "km|m|cm|mm|mi|miles?|ft|feet|inch(?:es)?|kg|g|mg|lbs?|pounds?|oz|l|ml|lit(?:er|re)s?|gallons?|s|sec(?:onds?)?|min(?:utes?)?|h|hours?|days?|weeks?|months?|years?|%|percent|dollars?|cents?|euros?|usd|eur|mph|kph|°c|°f|degrees?"


def canonical(text: Column) -> Column:
    """The text with placeholders for numbers, names and units; white space is left as it is."""
    marked = F.when(text.rlike("[0-9]"), F.regexp_replace(F.regexp_replace(text, r"[0-9]+(?:[.,:/][0-9]+)*", "<num>"), rf"(?i)(?<=<num>[ ]?)(?:{UNITS})(?![\p{{L}}<])", "<unit>")).otherwise(text)
    return F.lower(F.regexp_replace(marked, r"(?<=[\p{Ll},;:] )\p{Lu}\p{Ll}+", "<name>"))


def _tokens(text: Column) -> Column:
    return F.filter(F.split(text, r"[ \t\n\r\x0B\f]+"), lambda t: t != "")


def _sided(rows: DataFrame) -> DataFrame:
    """(id, canon, raw): canonical tokens and the tokens they stand for."""
    return rows.select("id", _tokens(canonical(F.col("text"))).alias("canon"), _tokens(F.col("text")).alias("raw"))


def windows(rows: DataFrame, step: int, slots: bool, window: int = WINDOW) -> DataFrame:
    """(id, key[, slot values, place]) of every ``step``-th window of ``rows (id, canon[, raw])``."""
    starts = F.when(F.size("canon") >= window, F.sequence(F.lit(1), F.size("canon") - (window - 1), F.lit(step))).otherwise(F.array().cast("array<int>"))

    def one(at: Column) -> Column:
        own = F.slice("canon", at, window)
        fields = [F.xxhash64(own).alias("key")]
        if slots:
            pairs = F.arrays_zip(own.alias("c"), F.slice("raw", at, window).alias("r"))
            held = F.filter(pairs, lambda p: p["c"].contains("<num>") | p["c"].contains("<name>") | p["c"].contains("<unit>"))
            fields += [F.transform(held, lambda p: F.lower(p["r"])).alias("held"), at.alias("at")]
        return F.struct(*fields)

    return rows.select("id", F.inline(F.transform(starts, one)))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, n_found, n_windows, n_slots, n_consistent) of every contaminating pair."""
    items = _sided(benchmark.select(F.col(item_col).alias("id"), F.col(item_text_col).cast("string").alias("text")))
    # one pass over the items: the shortest that has a window, and how many windows there are
    size = items.where(F.size("canon") >= window).agg(F.min(F.size("canon")).alias("least"), F.sum(F.size("canon")).alias("n")).first()
    step = max(1, min(window, (size["least"] or 1) - window + 1))
    small = (size["n"] or 0) <= MAX_BROADCAST
    index = windows(items, 1, True, window).select(F.col("id").alias("item_id"), "key", F.col("held").alias("item_held"), F.col("at").alias("item_at"))
    total = index.groupBy("item_id").agg(F.countDistinct("key").alias("n_windows"))
    keys = index.select("key").distinct()

    def near(side: DataFrame) -> DataFrame:
        return F.broadcast(side) if small else side

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    plain = rows.select("id", _tokens(canonical(F.col("text"))).alias("canon"))
    anchored = windows(plain, step, False, window).join(near(keys), "key", "left_semi").select(F.col("id").alias("_id")).distinct()
    full = windows(_sided(rows.join(anchored, F.col("id").eqNullSafe(F.col("_id")), "left_semi")), 1, True, window)
    found = full.join(near(index), "key").join(near(total), "item_id").select(F.col("id").alias("doc_id"), "item_id", "n_windows", "key", (F.col("at") - F.col("item_at")).alias("offset"), F.arrays_zip("item_held", "held").alias("slots"))
    along = Window.partitionBy("doc_id", "item_id").orderBy("offset")
    far = F.coalesce(F.col("offset") - F.lag("offset").over(along) > F.col("n_windows") / 2, F.lit(False))
    runs = found.withColumn("far", far.cast("int")).withColumn("run", F.sum("far").over(along))
    # kind 0: the whole document, 1: a run of near offsets, 2: one offset
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), place.cast("long").alias("place")) for k, place in enumerate([F.lit(0), F.col("run"), F.col("offset")])])
    placed = runs.select("doc_id", "item_id", "n_windows", "key", "slots", F.inline(kinds))
    pair = ["doc_id", "item_id", "kind", "place"]
    hits = placed.groupBy(*pair, "n_windows").agg(F.countDistinct("key").alias("n_found"))
    values = placed.select(*pair, F.explode("slots").alias("slot")).groupBy(*pair, F.col("slot.item_held").alias("value")).agg((F.min("slot.held") == F.max("slot.held")).alias("same"))
    slots = values.groupBy(*pair).agg(F.count("*").alias("n_slots"), F.sum(F.col("same").cast("long")).alias("n_consistent"))
    slots = slots.select(*[F.col(c).alias(f"_{c}") for c in pair], "n_slots", "n_consistent")
    same = F.lit(True)
    for c in pair:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    scored = hits.join(slots, same, "left").na.fill(0, ["n_slots", "n_consistent"])
    enough = (F.col("n_found") >= similarity * F.col("n_windows")) & (F.col("n_consistent") >= similarity * F.col("n_slots"))
    best = F.max(F.struct(F.col("kind") == 0, "n_found", "n_windows", "n_slots", "n_consistent")).alias("best")
    return scored.where(enough).groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.n_found", "best.n_windows", "best.n_slots", "best.n_consistent")


def op4_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``documents`` table against the whole ``benchmark`` table."""
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
