"""Toxicity of texts: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A feature is a character n-gram of the lower-cased text, hashed; its value is the log-count ratio of the two
classes if the text has it, else 0. The features that tell the classes apart best (chi-square) go into a
logistic regression. Counting and scoring run in Spark over whole texts. The model is fitted on a sample of
the labelled rows, whose expected size is a parameter, so the fit costs the same for any corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm import stages

ORDERS = (3, 4, 5)
SLICE_CHARS = 1 << 20
_HASH_BITS = 20
_BLOCK_BITS = 16
_FACTORS = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F, 0x165667B1)
_SPREAD = 0x9E3779B1


@dataclass(frozen=True)
class Settings:
    """How the classifier is fitted.

    ``sample_rows`` bounds the labelled rows it is fitted on (in expectation: rows are chosen by a hash);
    ``features`` bounds the features that go into the regression.
    """

    sample_rows: int = 20_000
    sample_tasks: int = 12
    least_documents: int = 5
    features: int = 4096
    smoothing: float = 1.0
    penalty: float = 1e-3
    iterations: int = 300
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """Hashed n-grams in ascending order, the weight that each adds to the score's logit, and the rest of it."""

    grams: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0


def _characters(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of whole texts as code points, with a blank at both ends of each text."""
    first = 0
    while first < len(texts):
        parts, total, last = [], 0, first
        while last < len(texts) and (total < SLICE_CHARS or last == first):
            parts.append(f" {(texts[last].as_py() or '').lower()} ".encode("utf-32-le", "surrogatepass"))
            total += len(parts[-1]) // 4
            last += 1
        offsets = np.concatenate([[0], np.cumsum([len(part) // 4 for part in parts])])
        yield first, last, np.frombuffer(b"".join(parts), np.uint32), offsets
        first = last


def _hashed(characters: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order the hashed n-grams, and for each text where its own start and end among them.

    N-grams across two texts are among them; the ends leave them out.
    """
    total = characters * np.uint32(_FACTORS[0])
    for place in range(1, max(ORDERS)):
        total = total[:-1] + characters[place:] * np.uint32(_FACTORS[place])
        order = place + 1
        if order in ORDERS:
            spread = (total ^ (total >> np.uint32(15)) ^ np.uint32(order)) * np.uint32(_SPREAD)
            starts = offsets[:-1]
            yield spread >> np.uint32(32 - _HASH_BITS), np.stack([starts, np.maximum(starts, offsets[1:] - order + 1)])
        if not len(total):
            return


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of each class each hashed n-gram occurs, in blocks of n-grams."""
    counts = np.zeros((2, 1 << _HASH_BITS), np.uint32)
    for batch in batches:
        labels = batch.column(1).to_pylist()
        for first, last, characters, offsets in _characters(batch.column(0)):
            hashed = list(_hashed(characters, offsets))
            for n in range(last - first):
                own = np.unique(np.concatenate([grams[ends[0, n] : ends[1, n]] for grams, ends in hashed] or [np.zeros(0, np.uint32)]))
                counts[labels[first + n], own] += 1
    size = 1 << _BLOCK_BITS
    for block in range(len(counts[0]) // size):
        clean, toxic = (row[block * size : (block + 1) * size].tobytes() for row in counts)
        yield pa.RecordBatch.from_pydict({"block": [block], "clean": [clean], "toxic": [toxic]})


def _select(clean_texts: int, toxic_texts: int, settings: Settings):
    """Log-count ratio and chi-square of one block's n-grams; those in few texts are left out."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        clean, toxic = (np.sum([np.frombuffer(data, np.uint32) for data in rows[name]], axis=0, dtype=np.int64) for name in ("clean", "toxic"))
        seen = np.flatnonzero(clean + toxic >= settings.least_documents)
        a, b = toxic[seen].astype(float), clean[seen].astype(float)
        share = (toxic_texts + clean_texts) / (toxic_texts * clean_texts)
        both = a + b
        rest = np.maximum(toxic_texts + clean_texts - both, 1e-9)
        squared = (a * clean_texts - b * toxic_texts) ** 2 * share / (both * rest)
        # Sums of all counts, so that the ratio compares shares of a class.
        ratio = np.log((a + settings.smoothing) / (toxic_texts + 2 * settings.smoothing)) - np.log(
            (b + settings.smoothing) / (clean_texts + 2 * settings.smoothing)
        )
        best = np.argsort(-squared, kind="stable")[: settings.features]
        return pd.DataFrame(
            {"gram": seen[best] + int(rows["block"].iloc[0]) * (1 << _BLOCK_BITS), "ratio": ratio[best], "chi2": squared[best]}
        )

    return run


def _present(table: np.ndarray, characters: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts and chosen features, each pair once."""
    found = []
    for grams, ends in _hashed(characters, offsets):
        features = table[grams]
        at = np.flatnonzero(features >= 0)
        owner = np.searchsorted(ends[0], at, "right") - 1
        inside = at < ends[1][owner]
        found.append(owner[inside] * np.int64(1 << _HASH_BITS) + features[at[inside]])
    pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return pairs >> _HASH_BITS, pairs & ((1 << _HASH_BITS) - 1)


def _table(grams: np.ndarray) -> np.ndarray:
    table = np.full(1 << _HASH_BITS, -1, np.int32)
    table[grams] = np.arange(len(grams))
    return table


def _features(grams: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(grams)
        for batch in batches:
            for first, last, characters, offsets in _characters(batch.column(0)):
                owner, chosen = _present(table, characters, offsets)
                edges = np.searchsorted(owner, np.arange(last - first + 1))
                rows = [chosen[a:b].astype(np.uint16).tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(first, last - first), pa.array(rows, pa.binary())], names=["label", "features"]
                )

    return run


def _regress(labels: np.ndarray, rows: list[np.ndarray], ratios: np.ndarray, settings: Settings) -> tuple[np.ndarray, float]:
    """Logistic regression with a quadratic penalty, by full-gradient steps with adaptive sizes."""
    owner = np.repeat(np.arange(len(rows)), [len(row) for row in rows])
    feature = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    value = ratios[feature]
    weights, bias = np.zeros(len(ratios) + 1), np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1))
    weights[-1] = bias
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, settings.iterations + 1):
        logit = np.bincount(owner, weights[feature] * value, len(rows)) + weights[-1]
        error = (1 / (1 + np.exp(-logit)) - labels) / len(labels)
        gradient = np.append(np.bincount(feature, error[owner] * value, len(ratios)), error.sum())
        gradient[:-1] += settings.penalty * weights[:-1]
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        rate = 0.05 * (1 - (step - 1) / settings.iterations)
        weights -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-10)
    return weights[:-1], float(weights[-1])


def held_out(key: str = "doc_id"):
    """Whether a row's label must not be learnt from: CRC-32 of the key as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", settings: Settings = Settings()
) -> Model:
    """Learn from the labelled rows that are not held out.

    Rows without key, or with a label other than 0 and 1, are not learnt from; of several labels of a key the
    largest counts. With labels of one class only, or none, as in empty tables, the model knows nothing but their
    share. Repeated rows of one key and text are learnt from once. The sample holds about ``sample_rows`` rows, also where
    many texts share a key. Texts are read whole. Other columns are not read, so their names may clash.
    """
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).filter("label IN (0, 1)")
    known = known.groupBy("key").agg(F.max("label").alias("label")).filter(~held_out("key"))
    total = known.count()
    # A hash chooses the rows, so the sample is spread over all of them and the same in every run.
    steps = 1 << 30
    share = int(steps * min(1.0, settings.sample_rows / max(1, total)))
    chosen = known.filter(F.pmod(F.xxhash64(F.lit(settings.seed), "key"), F.lit(steps)) < share)
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    # At most about ``sample_rows`` rows of two numbers are broadcast.
    labelled = rows.join(F.broadcast(chosen), "key")
    # Keys were chosen, but rows are what has to be bounded: copies count once, and where keys have many texts a hash
    # chooses among these too.
    digest = F.xxhash64(F.lit(settings.seed), "key", "text")
    found = labelled.agg(F.approx_count_distinct(digest, 0.02)).first()[0]
    if found > 1.1 * settings.sample_rows:
        labelled = labelled.filter(F.pmod(digest, F.lit(steps)) < int(steps * settings.sample_rows / found))
    sample = labelled.dropDuplicates(["key", "text"]).select("text", "label").repartition(settings.sample_tasks)
    sample, _ = stages.written(sample, "toxicity-sample")
    sizes = {row.label: row["count"] for row in sample.groupBy("label").count().collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not clean or not toxic:
        return Model(bias=float(np.log((toxic + 1) / (clean + 1))))
    counted = sample.mapInArrow(_count, "block long, clean binary, toxic binary")
    ranked = counted.groupBy("block").applyInPandas(_select(clean, toxic, settings), "gram long, ratio double, chi2 double")
    best = ranked.orderBy(F.desc("chi2"), "gram").limit(settings.features).toPandas().sort_values("gram")
    grams, ratios = best["gram"].to_numpy(), best["ratio"].to_numpy()
    found = sample.mapInArrow(_features(grams), "label int, features binary").toPandas()
    rows_of_features = [np.frombuffer(data, np.uint16).astype(np.int64) for data in found["features"]]
    weights, bias = _regress(found["label"].to_numpy(float), rows_of_features, ratios, settings)
    return Model(grams, weights * ratios, bias)


def score(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``score`` (0 to 1) of every whole text, and the columns named in ``keep``, which play no part in it.

    A null or empty text has no n-grams and gets the score of the bias. Rows are scored one by one, so
    repeated rows get one score. An empty table gives an empty one.
    """
    # The text itself is sent to Python once, and back only if it is to be kept.
    names = {name: "t" if name == text else f"c{n}" for n, name in enumerate(keep or [])}
    kept = [F.col(f"`{name}`").alias(inner) for name, inner in names.items() if inner != "t"]
    rows = df.select(F.col(text).alias("t"), *kept)
    kinds = [kind for kind in rows.schema.fields if kind.name in names.values()]
    ddl = ", ".join(["score double", *(f"{kind.name} {kind.dataType.simpleString()}" for kind in kinds)])
    first_kept = 0 if "t" in names.values() else 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(model.grams)
        for batch in batches:
            for first, last, characters, offsets in _characters(batch.column(0)):
                owner, chosen = _present(table, characters, offsets)
                logit = np.bincount(owner, model.weights[chosen], last - first) + model.bias
                scores = 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
                columns = [batch.column(n).slice(first, last - first) for n in range(first_kept, batch.num_columns)]
                yield pa.RecordBatch.from_arrays([pa.array(scores), *columns], names=["score", *(kind.name for kind in kinds)])

    scored = rows.mapInArrow(run, ddl)
    return scored.select(*[F.col(inner).alias(name) for name, inner in names.items()], "score")
