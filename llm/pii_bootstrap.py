"""Operator 11, personal data: bootstrapped contextual extraction.

1. *Seeds.* Base grammars (e-mail, IP, card with Luhn digit, international phone) find the first entities
   of every text. Their values are the seed instances, with confidence 1.
2. *Candidates.* Looser grammars mark what might be such an entity and is not one by the base grammar:
   spelled-out or unfinished addresses, numbers of 7 to 15 digits (phone) or 12 to 19 (card) in any
   grouping, dotted or colon groups (IP). A candidate alone is never reported.
3. *Patterns.* Each seed and candidate stands in lexical patterns: the word before it, the two words
   before it, and the words on both sides (lower case, digits as ``0``, from at most ``CONTEXT``
   characters on each side).
4. *Graph.* Spark counts the distinct edges (kind, pattern, instance) of the whole table, then scores both
   sides in turn for ``ROUNDS`` rounds. A pattern's score is the confidence of its instances of a kind over all its
   instances of any kind plus ``CAUTION``; an instance's confidence is that of its best pattern, if it is ``ACCEPT``
   or more. So a pattern needs five or more pure seeds, and instances that it confirms may confirm others.
5. *Discovery.* Candidates in a pattern that scores ``ACCEPT`` or more are added under its kind (the best
   one, if several); overlapping additions keep the first, then the longest.

Only values' 64-bit hashes, patterns and positions leave the pass over the texts. Edges are distinct
before they are joined, aggregates combine before the shuffle, and each round's scores are a written table, so that joins
on a pattern or value that a third of all rows share can be split at run time (AQE). Nothing is collected.

Defined cases: null text counts as empty and has no spans (digest of the empty string); rows without an id or with
the same id are judged by id and text, equal rows alike; the same value in many copies is one instance;
positions are code points; a table without seeds adds nothing; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.shared import shared_path

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
ROUNDS = 3
ACCEPT = 0.6
CAUTION = 2.7
CONTEXT = 64
CARD_DIGITS, PHONE_DIGITS = range(14, 20), range(10, 16)
LOOSE_CARD, LOOSE_PHONE = range(12, 20), range(7, 16)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# matches at every digit, so that a long run of digits is passed once
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_NUMBER = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOOSE_NUMBER = re.compile(r"\+?[0-9](?:[\x20().\-/_]{0,2}[0-9])+")
_LOOSE_GROUPS = re.compile(r"[0-9A-Fa-f.:]+")
_SPELLED_AT = re.compile(r"\x20?[(\[{]\x20?at\x20?[)\]}]\x20?|\x20at\x20(?=[A-Za-z0-9-]+\x20dot\x20)")
_SPELLED_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:(?:\.|\x20?[(\[{]?\x20?dot\x20?[)\]}]?\x20?)[A-Za-z0-9-]+)*")
_TRIM = ".,;:!?\"'()[]{}<>"

Span = tuple[int, int, int]  # start, kind, end


def _digits(value: str) -> str:
    return "".join(c for c in value if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    own = [int(c) for c in digits]
    twice = [2 * d - 9 if d > 4 else 2 * d for d in own[-2::-2]]
    return (sum(own[::-2]) + sum(twice)) % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """For each ``@`` the characters of a local part before it, back to the last match."""
    last, at = 0, text.find("@")
    while at >= 0:
        lo = at
        while lo > last and text[lo - 1] in _LOCAL:
            lo -= 1
        if lo < at and (domain := _DOMAIN.match(text, at + 1)):
            yield lo, EMAIL, domain.end()
            last = domain.end()
        # what lies before this @ is no part of a later match
        last = max(last, at + 1)
        at = text.find("@", last)


def _ips(text: str) -> Iterator[Span]:
    """Numbers four by four in every maximal dotted run."""
    for run in _DOTTED.finditer(text):
        if run.group().count(".") < 3:
            continue
        parts = list(_NUMBER.finditer(text, *run.span()))
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            if all(len(v := p.group().lstrip("0")) <= 3 and int(v or 0) <= 255 for p in four):
                yield four[0].start(), IP, four[3].end()


def base_spans(text: str) -> list[Span]:
    """Entities by the base grammars, by start, then kind."""
    out: list[Span] = []
    if "@" in text:
        out += _emails(text)
    if _NUMBER.search(text):
        out += _ips(text)
        for m in _CARD.finditer(text):
            digits = _digits(m.group()) if len(m.group()) >= CARD_DIGITS[0] else ""
            if len(digits) in CARD_DIGITS and luhn(digits):
                out.append((m.start(), CARD, m.end()))
        out += [(m.start(), PHONE, m.end()) for m in _PHONE.finditer(text) if len(_digits(m.group())) in PHONE_DIGITS]
    return sorted(out)


def _spelled(text: str) -> Iterator[tuple[int, int]]:
    """Addresses with a spelled-out or single ``@`` that the base grammar refuses."""
    last = 0
    for m in [*_SPELLED_AT.finditer(text), *re.finditer("@", text)]:
        lo, floor = m.start(), max(last, m.start() - CONTEXT)
        while lo > floor and text[lo - 1] in _LOCAL:
            lo -= 1
        domain = _SPELLED_DOMAIN.match(text, m.end())
        if lo < m.start() and domain:
            yield lo, domain.end()
            last = domain.end()


def candidates(text: str, base: list[Span]) -> list[Span]:
    """Loose entities that meet no base span; one span may stand for several kinds."""
    found: list[Span] = []
    if "@" in text or "at" in text:
        found += [(lo, EMAIL, hi) for lo, hi in _spelled(text)]
    if _NUMBER.search(text):
        for m in _LOOSE_NUMBER.finditer(text):
            n = len(_digits(m.group())) if len(m.group()) >= LOOSE_PHONE[0] else 0
            found += [(m.start(), kind, m.end()) for kind, sizes in ((CARD, LOOSE_CARD), (PHONE, LOOSE_PHONE)) if n in sizes]
        for m in _LOOSE_GROUPS.finditer(text):
            value = m.group().strip(".:")
            if 2 <= value.count(".") + value.count(":") <= 7 and _NUMBER.search(value):
                lo = m.start() + m.group().index(value)
                found.append((lo, IP, lo + len(value)))
    found.sort()
    starts = [s[0] for s in base]
    reach = [0, *accumulate((s[2] for s in base), max)]  # the furthest end of the base spans before
    return [s for s in found if reach[bisect_left(starts, s[2])] <= s[0]]


def instance(text: str, span: Span) -> int:
    """Hash of a value: digits for numbers, lower-case letters and digits otherwise."""
    value = text[span[0] : span[2]]
    value = _digits(value) if span[1] in (CARD, PHONE) else value.lower()
    return int.from_bytes(hashlib.blake2b(value.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _word(word: str) -> str:
    return re.sub("[0-9]", "0", word.lower().strip(_TRIM.replace(":", "")))


def patterns(text: str, span: Span) -> list[str]:
    """The lexical patterns that a span stands in."""
    before = [_word(w) for w in text[max(0, span[0] - CONTEXT) : span[0]].split()[-2:]]
    after = [_word(w) for w in text[span[2] : span[2] + CONTEXT].split()[:1]]
    out = []
    if before and before[-1]:
        out.append(f"{before[-1]} <*>")
        if len(before) > 1:
            out.append(f"{before[-2]} {before[-1]} <*>")
        if after and after[0]:
            out.append(f"{before[-1]} <*> {after[0]}")
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{lo}:{hi}" for lo, kind, hi in sorted(spans))


_FOUND = "id long, text_hash long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base string, marks array<struct<kind:int,lo:int,hi:int,seed:boolean,instance:long,patterns:array<string>>>"
_MARK = pa.struct([("kind", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32()), ("seed", pa.bool_()), ("instance", pa.int64()), ("patterns", pa.list_(pa.string()))])


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, base, marks = [], [], []
        for value in pc.fill_null(batch.column("text"), ""):
            text = value.as_py()
            spans = base_spans(text)
            counts.append([sum(s[1] == k for s in spans) for k in range(len(KINDS))])
            base.append(joined(spans))
            both = [(s, True) for s in spans] + [(s, False) for s in candidates(text, spans)]
            marks.append([{"kind": s[1], "lo": s[0], "hi": s[2], "seed": seed, "instance": instance(text, s), "patterns": patterns(text, s)} for s, seed in both])
        cols = [batch.column("id"), batch.column("text_hash"), *(pa.array([c[k] for c in counts], pa.int64()) for k in range(len(KINDS))), pa.array(base, pa.string()), pa.array(marks, pa.list_(_MARK))]
        yield pa.RecordBatch.from_arrays(cols, ["id", "text_hash", *(f"n_{k}" for k in KINDS), "base", "marks"])


def _stored(spark: SparkSession, table: DataFrame, path: str) -> DataFrame:
    schema = table.schema
    table.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def scored_patterns(spark: SparkSession, found: DataFrame, base: str) -> DataFrame:
    """``kind, pattern, score`` of all patterns after the last round."""
    mark = found.select(F.explode("marks").alias("m")).select("m.kind", "m.seed", "m.instance", F.explode("m.patterns").alias("pattern"))
    edges = _stored(spark, mark.groupBy("kind", "pattern", "instance").agg(F.max("seed").alias("seed")), f"{base}/edges")
    # a value that is a seed of a kind anywhere is one everywhere
    seeds = edges.where("seed").select("kind", "instance").distinct().withColumn("confidence", F.lit(1.0))
    sure = _stored(spark, seeds, f"{base}/sure")
    # one instance counts once per pattern, however many kinds it may be
    degree = _stored(spark, edges.select("pattern", "instance").distinct().groupBy("pattern").agg(F.count("*").alias("degree")), f"{base}/degree")
    scores = None
    for r in range(ROUNDS):
        gained = edges.join(sure, ["kind", "instance"]).groupBy("kind", "pattern").agg(F.sum("confidence").alias("gain"))
        score = gained.join(degree, "pattern").select("kind", "pattern", (F.col("gain") / (F.col("degree") + CAUTION)).alias("score"))
        scores = _stored(spark, score, f"{base}/score{r}")
        if r + 1 < ROUNDS:
            told = edges.join(scores.where(F.col("score") >= ACCEPT), ["kind", "pattern"]).groupBy("kind", "instance").agg(F.max("score").alias("confidence"))
            every = seeds.unionByName(told).groupBy("kind", "instance").agg(F.max("confidence").alias("confidence"))
            sure = _stored(spark, every, f"{base}/sure{r}")
    return scores


def discovered(found: DataFrame, scores: DataFrame) -> DataFrame:
    """``id, text_hash, more``: the spans that accepted patterns add to a text, as (lo, kind, hi)."""
    accepted = scores.where(F.col("score") >= ACCEPT)
    open_ = found.where(F.exists("marks", lambda m: ~m["seed"])).select("id", "text_hash", F.explode("marks").alias("m")).where("not m.seed")
    at = open_.select("id", "text_hash", "m.kind", "m.lo", "m.hi", F.explode("m.patterns").alias("pattern"))
    met = at.join(accepted, ["kind", "pattern"]).groupBy("id", "text_hash", "lo", "hi", "kind").agg(F.max("score").alias("score"))
    one = met.groupBy("id", "text_hash", "lo", "hi").agg(F.max(F.struct("score", -F.col("kind"))).alias("best"))
    kind = (-F.col("best")["col2"]).cast("int").alias("kind")
    return one.groupBy("id", "text_hash").agg(F.sort_array(F.collect_list(F.struct("lo", (-F.col("hi")).alias("back"), kind))).alias("more"))


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pydict()
        digest, spans, added = [], [], []
        for base, more in zip(rows["base"], rows["more"], strict=True):
            digest.append(hashlib.sha256(base.encode()).hexdigest())
            new, reach = [], 0
            for m in more or []:
                if m["lo"] >= reach:
                    new.append((m["lo"], m["kind"], -m["back"]))
                    reach = -m["back"]
            old = [(int(lo), KINDS.index(kind), int(hi)) for kind, lo, hi in (x.split(":") for x in base.split(",") if x)]
            spans.append(joined(old + new))
            added.append(len(new))
        keep = ["doc_id", *(f"n_{k}" for k in KINDS)]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(digest, pa.string()), pa.array(spans, pa.string()), pa.array(added, pa.int64())], [*keep, "base_sha256", "spans", "n_added"])


def find_personal_data(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_email, n_ip, n_card, n_phone`` (base spans), ``base_sha256``, ``spans`` (all), ``n_added``."""
    base = shared_path(spark, f"pii/{uuid.uuid4().hex}")
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    found = _stored(spark, rows.mapInArrow(_scanned, _FOUND), f"{base}/found")
    more = _stored(spark, discovered(found, scored_patterns(spark, found, base)), f"{base}/more")
    same = (F.col("f.text_hash") == F.col("m.text_hash")) & F.col("f.id").eqNullSafe(F.col("m.id"))
    out = found.alias("f").join(more.alias("m"), same, "left").select(F.col("f.id").alias("doc_id"), *(f"f.n_{k}" for k in KINDS), "f.base", "m.more")
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return out.mapInArrow(_finished, f"doc_id long, {counts}, base_sha256 string, spans string, n_added long")


def op11_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``documents`` table."""
    return find_personal_data(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
