"""Token counts of whole texts from counts of their pre-tokens.

A text's number of tokens is the sum, over its distinct pre-tokens, of frequency times the
number of pieces of the pre-token. Pieces are counted once for each distinct pre-token and
joined to the frequencies; ids are never made. The most frequent pre-tokens of a sample, a
list of bounded length, travel to every task with their piece counts: that joins the hot
keys where the texts are read and leaves the shuffled join the rare ones, which are spread
evenly. The sample only decides where a pre-token is joined, never whether it counts.

Null and empty texts have no tokens. Repeated rows are counted each for itself, an empty table gives no rows, and
texts are counted whole, however long. Other columns than doc_id and text are left out, whatever their names. A vocabulary
that splits texts in another way than byte-level pre-tokens is refused.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_batch, slices, text_bytes, written
from tidemark.llm.word_ids import byte_letters

#: The vocabulary's special string, and its pre-token pattern over Latin text.
SPECIAL = "<|endoftext|>"
_LATIN = re.compile("[\n\r\t\x20-\x7e¡-©«-±´¶-¸»¿-ɏ‐-•…]*")
_PRETOKEN = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ɏ]+| ?[0-9]+| ?[^\\sA-Za-z0-9À-ÖØ-öø-ɏ]+|\\s+(?!\\S)|\\s+"
)
#: Most frequent pre-tokens of the sample that are joined where texts are read, and their greatest length: what is
#: sent holds at most ``FREQUENT * LONGEST`` characters.
FREQUENT, LONGEST = 250_000, 64
#: Documents of the sample, about.
SAMPLED = 12_000


def _refuse_others(vocabulary: str, path: str) -> None:
    """An error for a vocabulary that does not split texts as this module does: its counts would be wrong."""
    if not path.endswith(".json"):
        raise ValueError(f"no vocabulary of byte-level pre-tokens: {vocabulary}")
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    before, model = parts.get("pre_tokenizer") or {}, parts.get("model") or {}
    plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    special = [t["content"] for t in parts.get("added_tokens") or []]
    if not plain or parts.get("normalizer") or special != [SPECIAL] or model.get("type", "BPE") != "BPE" or model.get("dropout"):
        raise ValueError(f"this vocabulary splits texts in another way: {vocabulary}")


class Splitter:
    """Pre-tokens of a text and pieces of a pre-token, as the tokenizer's own parts give them."""

    def __init__(self, vocabulary: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        path = public_tokenizers.path(vocabulary)
        _refuse_others(vocabulary, path)
        self.tokenizer = Tokenizer.from_file(path)
        self.letters = dict(enumerate(byte_letters()))

    def pretokens(self, text: str) -> list[str]:
        if _LATIN.fullmatch(text):
            return _PRETOKEN.findall(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def frequencies(self, text: str) -> tuple[Counter, int]:
        """Pre-tokens with their numbers, and how many special strings stand between them."""
        parts = text.split(SPECIAL)
        found = Counter(self.pretokens(parts[0]))
        for part in parts[1:]:
            found.update(self.pretokens(part))
        return found, len(parts) - 1

    def pieces(self, pretoken: str) -> int:
        return len(self.tokenizer.model.tokenize(pretoken.encode().decode("latin-1").translate(self.letters)))


_LOADED: dict[str, Splitter] = {}


def splitter(vocabulary: str) -> Splitter:
    if vocabulary not in _LOADED:
        _LOADED[vocabulary] = Splitter(vocabulary)
    return _LOADED[vocabulary]


def _piece_counts(pretokens: DataFrame, vocabulary: str) -> DataFrame:
    schema = pa.schema([("pretoken", pa.string()), ("pieces", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter(vocabulary)
        for batch in batches:
            words = batch.column(0).to_pylist()
            yield arrow_batch(schema, {"pretoken": words, "pieces": [split.pieces(w) for w in words]})

    return pretokens.mapInArrow(count, "pretoken string, pieces long")


def _frequent(texts: DataFrame, vocabulary: str) -> dict[str, int]:
    """At most ``FREQUENT`` pre-tokens with their piece counts, from about ``SAMPLED`` documents."""
    schema = pa.schema([("pretoken", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, found = splitter(vocabulary), Counter()
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                found.update(split.frequencies(text.decode())[0])
        yield arrow_batch(schema, {"pretoken": list(found), "n": list(found.values())})

    rows = (
        texts.select("text")
        .sample(min(1.0, SAMPLED / max(1, texts.count())), seed=4)
        .mapInArrow(count, "pretoken string, n long")
        .groupBy("pretoken")
        .agg(F.sum("n").alias("n"))
        .where((F.col("n") > 1) & (F.length("pretoken") <= LONGEST))
        .orderBy(F.desc("n"), "pretoken")
        .limit(FREQUENT)
        .select("pretoken")
        .collect()
    )
    split = splitter(vocabulary)
    return {r["pretoken"]: split.pieces(r["pretoken"]) for r in rows}


def token_counts(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > ``limit``) of every document."""
    texts = docs.select(F.col("doc_id").alias("doc_id"), text_bytes("text").alias("text"))
    known = docs.sparkSession.sparkContext.broadcast(_frequent(texts, vocabulary))
    schema = pa.schema(
        [("row", pa.int64()), ("doc_id", pa.int64()), ("pretoken", pa.string()), ("n", pa.int64()), ("n_bytes", pa.int64())]
    )

    def split_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, pieces = splitter(vocabulary), known.value
        for batch in slices(batches):
            out: dict[str, list] = {name: [] for name in schema.names}
            rows, ids, pretokens, numbers, sizes = out.values()  # the document's id stands in its own row only
            for row, doc, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                found, total = split.frequencies(text.decode())
                rare = 0
                for pretoken, n in found.items():
                    each = pieces.get(pretoken)
                    if each is None:
                        pretokens.append(pretoken)
                        numbers.append(n)
                        rare += 1
                    else:
                        total += n * each
                pretokens.append(None)
                numbers.append(total)
                rows.extend([row] * (rare + 1))
                ids.extend([None] * rare + [doc])
                sizes.extend([None] * rare + [len(text)])
            yield arrow_batch(schema, out)

    # Rows with a pre-token wait for its pieces; the row without one has what is summed already.
    parts = written(
        texts.select(
            F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text"
        ).mapInArrow(split_texts, "row long, doc_id long, pretoken string, n long, n_bytes long"),
        "pretokens",
    )
    waiting = parts.where(F.col("pretoken").isNotNull())
    counted = _piece_counts(waiting.select("pretoken").distinct(), vocabulary)
    rare = (
        waiting.select("row", "pretoken", "n")
        .join(counted, "pretoken")
        .groupBy("row")
        .agg(F.sum(F.col("n") * F.col("pieces")).alias("rare"))
    )
    ready = parts.where(F.col("pretoken").isNull()).select("row", "doc_id", "n", "n_bytes")
    return (
        ready.join(rare, "row", "left")
        .withColumn("n_tokens", F.col("n") + F.coalesce("rare", F.lit(0)))
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
