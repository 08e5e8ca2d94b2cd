"""Operator 2, BPE encoding and decoding with a tokenization automaton.

The merge list of a public word-level BPE vocabulary is compiled into a deterministic automaton over
tokens that accepts exactly the correct tokenizations. The construction starts from one state that
loops on every base symbol and applies one *merge gadget* per merge ``(u, v) -> w``, in order:

* ``w`` leads where ``u`` then ``v`` led (a shortcut arc);
* ``u`` now leads to a copy of its state without the arc ``v``, as the pair must be merged.

A gadget adds one state, stored as a link to the state it copies and the merges it drops, so that
compiling takes time in proportion to the merges. A state's row of arcs is filled in as texts ask for it: an arc
``t`` exists unless the state dropped ``t``, or dropped a first part of ``t`` before that part became
part of ``t``. A word is encoded by walking the table from its start, taking the longest arc that
fits and stepping back where the walk ends; exactly one path reaches the end of the word. Decoding
emits the labels of the arcs.

Everything is local to a document: no shuffle, and hot documents need no care. The automaton (about
50,000 merges) is compiled once per Python worker from the vocabulary file's content, which the driver
reads and ships with the task; a vocabulary over ``MAX_VOCABULARY`` bytes is refused.

Normalisation and pre-splitting follow the file's declared parts (NFC, lower case, the split pattern,
byte-level letters, word-end suffix); a file that declares others is refused.

Defined cases: null text is empty: no ids, and empty decoded text; repeated rows give repeated rows;
strings of special tokens in a text become their ids; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import sys
from collections.abc import Iterator
from unicodedata import category, normalize

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_VOCABULARY = 64 << 20
#: Words remembered per Python worker; when full, the memory starts anew.
WORDS_KEPT = 300_000
FIRST = 4
SCHEMA = "doc_id bigint, n_tokens bigint, ids binary, decoded string"


def byte_letters() -> list[str]:
    """The printable letter of each byte in byte-level vocabularies: itself, or the next unused one from 256."""
    shown = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Automaton:
    """Tokens are numbered as in the vocabulary; states are numbered as they are made."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        self.labels: list[str | None] = [None] * (max(vocabulary.values()) + 1)
        for text, token in vocabulary.items():
            self.labels[token] = text
        self.inner = {s: t for s, t in vocabulary.items() if not s.endswith(suffix) or s == suffix}
        self.final = {s[: -len(suffix)]: t for s, t in vocabulary.items() if s.endswith(suffix) and s != suffix}
        self.reach: dict[str, int] = {}  # longest label by its first letters
        for label in (*self.inner, *self.final):
            for size in range(1, min(len(label), FIRST) + 1):
                self.reach[label[:size]] = max(self.reach.get(label[:size], 0), len(label))
        n = len(self.labels)
        self.parts: list[tuple[int, int] | None] = [None] * n
        self.born = [-1] * n  # number of the merge that made a token
        self.state = [0] * n  # where a token's arc leads
        # a state is the copies that one token's gadgets made so far (owner, the last one's number),
        # on top of the state that the token led to before its first gadget
        self.owner, self.made, self.below = [-1], [-1], [-1]
        self.rank: dict[tuple[int, int], int] = {}
        for k, (left, right) in enumerate(merges):
            self._gadget(k, vocabulary[left], vocabulary[right], vocabulary[left + right])
        self.rows: list[dict[int, bool]] = [{} for _ in self.owner]

    def _gadget(self, k: int, u: int, v: int, w: int) -> None:
        self.parts[w], self.born[w], self.state[w] = (u, v), k, self.state[v]
        self.rank[u, v] = k
        old = self.state[u]
        self.owner.append(u)
        self.made.append(k)
        self.below.append(self.below[old] if self.owner[old] == u else old)
        self.state[u] = len(self.owner) - 1

    def arc(self, state: int, token: int) -> bool:
        """The transition table, filled on demand."""
        has = self.rows[state].get(token)
        if has is None:
            has = self.rows[state][token] = self._arc(state, token)
        return has

    def _arc(self, state: int, token: int) -> bool:
        while state > 0:
            owner, made = self.owner[state], self.made[state]
            part, limit = token, made
            while True:
                if self.rank.get((owner, part), 1 << 60) <= limit:
                    return False  # dropped, and before the part became part of the token
                if self.parts[part] is None:
                    break
                limit, part = min(limit, self.born[part]), self.parts[part][0]
            state = self.below[state]
        return True

    def _room(self, word: str, at: int) -> int:
        """No label that fits at ``at`` is longer."""
        for size in range(FIRST, 0, -1):
            found = self.reach.get(word[at : at + size])
            if found is not None:
                return min(found, len(word) - at)
        return 0

    def encode(self, word: str) -> list[int]:
        """The one path over the arcs whose labels spell ``word``."""
        n, at, state = len(word), 0, 0
        path: list[tuple[int, int, int]] = []  # (state before, token, length)
        dead: set[int] = set()
        size = self._room(word, 0)
        while at < n:
            while size:
                end = at + size
                token = (self.final if end == n else self.inner).get(word[at:end])
                if token is not None and end not in dead and self.arc(state, token):
                    break
                size -= 1
            if size:
                path.append((state, token, size))
                state, at = self.state[token], at + size
                size = self._room(word, at)
            else:
                if not path:
                    raise ValueError(f"no tokenization of {word!r}")
                dead.add(at)
                state, _, size = path.pop()
                at -= size
                size -= 1
        return [token for _, token, _ in path]


def pinned(pattern: str) -> str:
    """The pattern with its letter and number classes spelled out by ``unicodedata``.

    The regex module knows later Unicode versions than the tokenizers library does.
    """
    kinds: dict[str, list[tuple[int, int]]] = {"L": [], "N": []}
    for code in range(sys.maxunicode + 1):
        spans = kinds.get(category(chr(code))[0])
        if spans is not None:
            if spans and spans[-1][1] == code - 1:
                spans[-1] = (spans[-1][0], code)
            else:
                spans.append((code, code))
    for kind, spans in kinds.items():
        body = "".join(f"\\U{lo:08x}-\\U{hi:08x}" for lo, hi in spans)
        pattern = pattern.replace(f"[\\p{{{kind}}}]", f"[{body}]").replace(f"\\p{{{kind}}}", body)
    return pattern


class Tokenizer:
    """A vocabulary file's normaliser, pre-splitter and automaton."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        kinds = [p["type"] for p in spec["normalizer"]["normalizers"]]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or split["behavior"] != "Removed" or not split["invert"] or level["use_regex"] or level["add_prefix_space"] or spec["decoder"] is not None or model["dropout"] is not None or model["ignore_merges"]:
            raise ValueError("not a lower-case word-level BPE vocabulary")
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model["end_of_word_suffix"])
        self.letters = byte_letters()
        self.pattern = regex.compile(pinned(split["pattern"]["Regex"]))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels = list(self.automaton.labels) + [None] * (max(self.special.values(), default=0) + 1 - len(self.automaton.labels))
        for text, token in self.special.items():
            self.labels[token] = text
        marks = sorted(self.special, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None
        self.words: dict[str, list[int]] = {}
        self.chunks: dict[bytes, list[int]] = {}

    def _plain(self, text: str) -> list[int]:
        if text.isascii():
            text = text.lower()
        else:
            text = normalize("NFC", text).replace("Σ", "σ").lower()  # letter by letter, without final sigma
        if text.isalpha():
            pieces = [text]
        elif text[:-1].isalpha() and text[-1] in ".,":
            pieces = [text[:-1], text[-1]]
        else:
            pieces = self.pattern.findall(text)
        out: list[int] = []
        for piece in pieces:
            ids = self.words.get(piece)
            if ids is None:
                if len(self.words) >= WORDS_KEPT:
                    self.words.clear()
                shown = piece if piece.isascii() and piece.isprintable() else "".join(map(self.letters.__getitem__, piece.encode()))
                ids = self.words[piece] = self.automaton.encode(shown)
            out += ids
        return out

    def _chunk(self, chunk: bytes) -> list[int]:
        """Ids of a stretch without ASCII white space; words never cross white space."""
        text = chunk.decode()
        if self.marks is None or "<" not in text:
            return self._plain(text)
        out: list[int] = []
        for piece in self.marks.split(text):
            out += [self.special[piece]] if piece in self.special else self._plain(piece)
        return out

    def encode(self, text: bytes) -> list[int]:
        known, out = self.chunks, []
        for chunk in text.split():
            ids = known.get(chunk)
            if ids is None:
                ids = self._chunk(chunk)
                if len(known) >= WORDS_KEPT:
                    known.clear()
                if len(chunk) <= 64:
                    known[chunk] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.labels.__getitem__, ids))


_ready: dict[str, Tokenizer] = {}


def encode_decode(spark: SparkSession, docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_tokens, ids`` (little-endian unsigned 32-bit), ``decoded``."""
    with open(path, encoding="utf-8") as file:
        content = file.read(MAX_VOCABULARY + 1)
    if len(content) > MAX_VOCABULARY:
        raise ValueError("vocabulary file too large")
    mark = hashlib.sha256(content.encode()).hexdigest()
    shipped = spark.sparkContext.broadcast(content)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if mark not in _ready:
            _ready[mark] = Tokenizer(shipped.value)
        tokenizer = _ready[mark]
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                count, coded, decoded = [], [], []
                for text in part.column(1).cast(pa.binary()):
                    ids = tokenizer.encode(text.as_py() or b"")
                    count.append(len(ids))
                    coded.append(np.array(ids, dtype="<u4").tobytes())
                    decoded.append(tokenizer.decode(ids))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(count, pa.int64()), pa.array(coded, pa.binary()), pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids", "decoded"])

    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return plain.mapInArrow(run, SCHEMA)


def op2_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``documents`` table with the public 49k word vocabulary."""
    import public_tokenizers

    out = encode_decode(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
