"""Language of whole texts by a bidirectional gated recurrent network over bytes.

The network (:mod:`tidemark.llm.byte_gru`) labels every byte position; a document's
probabilities are the mean over all its positions. Texts are run in windows of a fixed
width that cover them whole, so a batch of very different lengths stays even.

Training takes at most about ``SAMPLED`` documents of every language, chosen by a hash of
``doc_id``, and at most ``WINDOWS`` windows of each; one task trains and only the weights,
whose size is fixed, reach the driver. Prediction reads nothing but the text.

A null text or one without a letter is ``und`` with score 0; so is every text when no
labelled document is given. Repeated rows are predicted each, a null doc_id like any other; an empty table gives
no rows. Texts are read whole, however long. Other columns are passed on; those named held_out, lang_pred and score are replaced.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.byte_gru import WIDTH, ByteGru, windows_of
from tidemark.llm.common import slices, text_bytes, written

SAMPLED, WINDOWS = 800, 6
UNKNOWN = "und"
#: Languages whose counts are broadcast; more of them meet the rows in a shuffle.
BROADCAST_LANGUAGES = 100_000
_LETTER = re.compile("[A-Za-z]")


def _has_letter(text: str) -> bool:
    return bool(_LETTER.search(text)) or any(c.isalpha() for c in text)


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> ByteGru | None:
    """A network from rows with a language; null where there is none."""
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = written(rows.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")), "languages")
    if counts.count() <= BROADCAST_LANGUAGES:  # texts stay where they are
        counts = F.broadcast(counts)
    share = F.least(F.lit(1.0), F.lit(float(SAMPLED)) / F.col("n"))
    place = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sampled = (
        rows.select(F.col(lang).alias("lang"), text_bytes(text).alias("text"), place.alias("place"))
        .join(counts, "lang")
        .where(F.col("place") < share)
        .select("lang", "text")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            langs, found = [], []
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                windows, lengths, _ = windows_of([raw])
                whole = np.flatnonzero(lengths == WIDTH) if len(raw) >= WIDTH else np.arange(len(windows))
                for i in whole[:: -(-len(whole) // WINDOWS) or 1]:
                    langs.append(name)
                    found.append(windows[i].tobytes())
            yield pa.RecordBatch.from_pydict({"lang": pa.array(langs, pa.string()), "window": pa.array(found, pa.binary())})

    def fit(group: pa.Table) -> pa.Table:
        group = group.sort_by([("lang", "ascending"), ("window", "ascending")])
        names = sorted(set(group.column("lang").to_pylist()))
        labels = np.array([names.index(x) for x in group.column("lang").to_pylist()])
        windows = np.frombuffer(b"".join(group.column("window").to_pylist()), dtype=np.uint8).reshape(-1, WIDTH)
        network = ByteGru.fresh(names).train(windows, labels)
        out = io.BytesIO()
        np.savez(out, **network.p)
        return pa.table({"names": pa.array([names], pa.list_(pa.string())), "weights": pa.array([out.getvalue()], pa.binary())})

    fitted = (
        sampled.mapInArrow(cut, "lang string, window binary")
        .groupBy(F.lit(1).alias("one"))
        .applyInArrow(fit, "names array<string>, weights binary")
        .collect()
    )
    if not fitted:
        return None
    with np.load(io.BytesIO(bytes(fitted[0]["weights"]))) as p:
        return ByteGru(list(fitted[0]["names"]), {k: p[k] for k in p.files})


def predict(docs: DataFrame, network: ByteGru | None, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score, which replace columns of these names."""
    plain = docs.drop("lang_pred", "score").withColumn(text, F.col(text).cast("string"))
    if network is None:
        return plain.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    sent = docs.sparkSession.sparkContext.broadcast((network.names, network.p))
    shape = ", ".join(f"`{c}` {kind}" for c, kind in plain.dtypes) + ", lang_pred string, score double"

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = ByteGru(*sent.value)
        names = np.array([*model.names, UNKNOWN], dtype=object)
        for batch in slices(batches, 256):
            column = batch.column(batch.schema.get_field_index(text))
            known = np.array([t is not None and _has_letter(t) for t in column.to_pylist()], dtype=bool)
            raw = [t if k else b"" for t, k in zip(column.cast(pa.binary()).to_pylist(), known, strict=True)]
            best, score = np.full(len(raw), len(names) - 1), np.zeros(len(raw))
            if known.any():
                windows, lengths, counts = windows_of(raw)
                sums = model.window_sums(windows, lengths)
                at = (np.cumsum(counts) - counts)[known]
                pooled = np.add.reduceat(sums, at, axis=0, dtype=np.float64)
                pooled /= pooled.sum(axis=1, keepdims=True)
                best[known], score[known] = pooled.argmax(axis=1), pooled.max(axis=1)
            batch = batch.append_column("lang_pred", pa.array(names[best], pa.string()))
            yield batch.append_column("score", pa.array(score, pa.float64()))

    return plain.mapInArrow(label, shape)


def held_out(key: str = "doc_id") -> Column:
    """Documents that no training sees: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """``docs`` with held_out, lang_pred and score, from a network trained on the rest of ``docs``."""
    network = train(docs.where(~held_out()))
    return predict(docs.drop("held_out").withColumn("held_out", held_out()), network)
