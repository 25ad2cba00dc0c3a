"""Document quality from weak labels: heuristic labellers, a label model, a hashed linear scorer.

Ten heuristics vote good, bad or abstain on every document. Expectation-maximisation over
the counts of vote patterns (at most ``3 ** 10``, whatever the number of documents)
estimates how each labeller votes on good and on bad documents, and with that the
posterior of every pattern. A logistic model over hashed words and word shapes learns these
posteriors from at most about ``SAMPLED`` documents and scores all documents; it sees whole
texts and no votes, so it also judges what every heuristic abstains on.

No given label is read. A null text or one without words scores 0. Repeated rows are scored
each, a null doc_id like any other; an empty table gives no rows; texts are read whole, however long; other columns are left
out, whatever their names.
"""

from __future__ import annotations

import io
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_batch, slices, text_bytes, written

GOOD, BAD, ABSTAIN = 1, 0, 2
SAMPLED = 6_000
BUCKETS = 1 << 15
#: A document is kept from this score on.
KEPT_FROM = 0.2
_MARKS = b"#*$%&^~|=<>{}\\!_@"
_CAPITALS = bytes(range(65, 91))
_LETTERS = bytes(b for b in range(256) if 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
_ENDS = re.compile(rb"[.!?](?:\s|$)")
_SHAPE = bytes.maketrans(bytes(range(256)), bytes(65 if 65 <= b <= 90 else 97 if b >= 128 or 97 <= b <= 122 else 48 if 48 <= b <= 57 else b for b in range(256)))


def _count(text: bytes, wanted: bytes) -> int:
    return len(text) - len(text.translate(None, wanted))


def _vote(value: float, good: tuple[float, float], bad: tuple[float, float]) -> int:
    """Good or bad where ``value`` lies in the range of one of them, else abstain."""
    return GOOD if good[0] <= value <= good[1] else BAD if bad[0] <= value <= bad[1] else ABSTAIN


def votes(text: bytes, found: list[bytes], counts: Counter) -> tuple[int, ...]:
    """The ten votes on a text, its words and their counts."""
    n, size = len(found), max(1, len(text))
    letters = max(1, _count(text, _LETTERS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    common = sorted(counts.values(), reverse=True)
    inf = float("inf")
    return (
        _vote(_count(text, _MARKS) / size, (0, 0.004), (0.02, 1)),
        _vote(_count(text, _CAPITALS) / letters, (0.002, 0.12), (0.3, 1)),
        _vote(common[0] / n if n > 20 else 2, (0, 0.12), (0.25, 1)),
        _vote(len(counts) / n if n > 20 else 2, (0.3, 1), (0, 0.12)),
        _vote(1 - len(set(lines)) / len(lines) if lines else 1, (0, 0.02) if len(lines) > 2 else (2, 2), (0.3, 1)),
        _vote(letters / max(1, n), (3.0, 9.0), (12, inf)),
        _vote(len(_ENDS.findall(text)) / max(1, n), (0.02, 0.25), (0, 0.004) if n > 100 else (2, 2)),
        _vote(text.count(b"|") / max(1, n), (0, 0), (0.1, inf)),
        _vote(n, (40, inf), (0, 0)),
        _vote(sum(common[:10]) / n if n > 60 else 2, (0.1, 0.55), (0.8, 1)),
    )


LABELLERS = 10


class LabelModel:
    """Share of good documents, and the chance of each vote of each labeller by class."""

    def __init__(self, good: float, chances: np.ndarray):
        self.good, self.chances = good, chances  # chances[labeller, class, vote]

    @staticmethod
    def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 60) -> LabelModel:
        """Expectation-maximisation from the majority of votes; Laplace-smoothed."""
        good_votes, bad_votes = (patterns == GOOD).sum(axis=1), (patterns == BAD).sum(axis=1)
        posterior = np.where(bad_votes == 0, 0.9, np.where(good_votes > 3 * bad_votes, 0.6, 0.1))
        model = None
        for _ in range(rounds):
            weight = np.stack([(1 - posterior) * counts, posterior * counts])
            chances = np.empty((patterns.shape[1], 2, 3))
            for i in range(patterns.shape[1]):
                for vote in range(3):
                    chances[i, :, vote] = weight[:, patterns[:, i] == vote].sum(axis=1) + 1
            chances /= chances.sum(axis=2, keepdims=True)
            model = LabelModel(float((weight[1].sum() + 1) / (counts.sum() + 2)), chances)
            posterior = model.posterior(patterns)
        return model

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of a good document for each row of votes."""
        odds = np.full(len(patterns), np.log(self.good / (1 - self.good)))
        for i in range(patterns.shape[1]):
            odds += np.log(self.chances[i, 1, patterns[:, i]] / self.chances[i, 0, patterns[:, i]])
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))

    def accuracies(self) -> np.ndarray:
        """How often each labeller is right when it votes."""
        prior = np.array([1 - self.good, self.good])
        right = prior[0] * self.chances[:, 0, BAD] + prior[1] * self.chances[:, 1, GOOD]
        return right / (prior[None, :, None] * self.chances[:, :, :2]).sum(axis=(1, 2))


def features(counts: Counter, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed buckets and weights of a text's words and of the shapes of its words, of length one."""
    found: Counter = Counter()
    shapes: Counter = Counter()
    for word, times in counts.items():
        found[zlib.crc32(word.lower()) % BUCKETS] += times
        shape = word.translate(_SHAPE)
        shapes[b"\x00" + shape[:1] + shape[-3:].lstrip(b"a")] += times
    for shape, times in shapes.items():
        found[zlib.crc32(shape) % BUCKETS] += 4 * times
    place = np.fromiter(found, dtype=np.int64, count=len(found))
    weight = np.sqrt(np.fromiter(found.values(), dtype=np.float64, count=len(found)) / max(1, n))
    repeated = 1 - len(counts) / max(1, n)
    place, weight = np.append(place, BUCKETS), np.append(weight, repeated)
    return place, weight / max(1e-9, np.sqrt((weight * weight).sum()))


class Scorer:
    """A logistic model over hashed features."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    @staticmethod
    def fit(rows: list[tuple[np.ndarray, np.ndarray]], targets: np.ndarray, rounds: int = 12, rate: float = 1.0) -> Scorer:
        """Adagrad on soft targets, in an order fixed by a seed."""
        weights, seen, bias = np.zeros(BUCKETS + 1), np.full(BUCKETS + 1, 0.1), 0.0
        rng = np.random.default_rng(9)
        for _ in range(rounds):
            for i in rng.permutation(len(rows)):
                place, value = rows[i]
                miss = 1 / (1 + np.exp(-np.clip(weights[place] @ value + bias, -50, 50))) - targets[i]
                step = miss * value
                seen[place] += step * step
                weights[place] -= rate * step / np.sqrt(seen[place])
                bias -= 0.02 * miss
        return Scorer(weights, bias)

    def score(self, place: np.ndarray, value: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights[place] @ value + self.bias, -50, 50))))


def score_quality(docs: DataFrame, kept_from: float = KEPT_FROM) -> DataFrame:
    """doc_id, votes, posterior (of the label model), score (of the linear model) and kept."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", text_bytes("text").alias("text"))
    kind = dict(docs.dtypes)["doc_id"]

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = []
            for text in batch.column(1).to_pylist():
                words = text.split()
                found.append("".join(map(str, votes(text, words, Counter(words)))))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "votes": pa.array(found, pa.string())})

    voted = written(texts.mapInArrow(vote, f"doc_id {kind}, votes string"), "votes")
    patterns = voted.groupBy("votes").agg(F.count("*").alias("n")).collect()  # at most 3 ** LABELLERS rows
    if not patterns:
        return voted.selectExpr("*", "0.0D AS posterior", "0.0D AS score", "false AS kept")
    table = np.array([[int(c) for c in r["votes"]] for r in patterns])
    model = LabelModel.fit(table, np.array([r["n"] for r in patterns], dtype=np.float64))
    sent = spark.sparkContext.broadcast((model.good, model.chances))

    total = sum(r["n"] for r in patterns)
    picked = texts.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 20)) < F.lit(min(1.0, SAMPLED / total) * (1 << 20)))

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label = LabelModel(*sent.value)
        schema = pa.schema([("one", pa.int32()), ("target", pa.float64()), ("place", pa.binary()), ("value", pa.binary())])
        for batch in slices(batches):
            out: dict[str, list] = {"one": [], "target": [], "place": [], "value": []}
            for text in batch.column(1).to_pylist():
                words = text.split()
                counts = Counter(words)
                place, value = features(counts, len(words))
                out["one"].append(1)
                out["target"].append(float(label.posterior(np.array([votes(text, words, counts)]))[0]))
                out["place"].append(place.tobytes())
                out["value"].append(value.tobytes())
            yield arrow_batch(schema, out)

    def fit(group: pa.Table) -> pa.Table:
        group = group.sort_by([("place", "ascending"), ("value", "ascending")])
        rows = [
            (np.frombuffer(p, np.int64), np.frombuffer(v, np.float64))
            for p, v in zip(group.column("place").to_pylist(), group.column("value").to_pylist(), strict=True)
        ]
        scorer = Scorer.fit(rows, group.column("target").to_numpy())
        out = io.BytesIO()
        np.save(out, np.append(scorer.weights, scorer.bias))
        return pa.table({"weights": pa.array([out.getvalue()], pa.binary())})

    fitted = (
        picked.mapInArrow(sparse, "one int, target double, place binary, value binary")
        .groupBy("one")
        .applyInArrow(fit, "weights binary")
        .collect()
    )
    raw = np.load(io.BytesIO(bytes(fitted[0]["weights"]))) if fitted else np.zeros(BUCKETS + 2)
    linear = spark.sparkContext.broadcast(raw)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, scorer = LabelModel(*sent.value), Scorer(linear.value[:-1], float(linear.value[-1]))
        for batch in slices(batches):
            found, scores = [], []
            for text in batch.column(1).to_pylist():
                words = text.split()
                counts = Counter(words)
                found.append(votes(text, words, counts))
                scores.append(scorer.score(*features(counts, len(words))) if words else 0.0)
            posterior = label.posterior(np.array(found)) if found else []
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0),
                    "votes": pa.array(["".join(map(str, v)) for v in found], pa.string()),
                    "posterior": pa.array(posterior, pa.float64()),
                    "score": pa.array(scores, pa.float64()),
                }
            )

    judged = texts.mapInArrow(judge, f"doc_id {kind}, votes string, posterior double, score double")
    return judged.withColumn("kept", F.col("score") >= kept_from)
