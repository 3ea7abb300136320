"""Toxicity: a convolutional text classifier, trained in numpy.

A word's embedding is the sum of hashed rows for the word and for its first
four and five bytes (stems carry over to inflected forms). Filters of one,
two and three words slide over the text; each filter's largest value, cut at
zero, feeds a logistic output.

Training reads a bounded sample of labelled rows, whole texts: at most
``sample_rows`` of each class, in the order of a hash of the id, and no more
rows once the texts of a class reach ``sample_bytes``. A fifth of the sample, by another hash, is not learnt from.

Calibration reads all labelled rows that the model did not learn from. They
are scored on Spark and counted by language, label and a narrow step of the
logit. The score is shifted so that 0.5 is the best overall cut, and each
language with at least ``least_rows`` of those rows in both classes gets its
own threshold on the score. In a rarer language the rows that were learnt from
count too, each by a model trained without that row's fifth of the sample and
shifted by its own best cut there (cross-fitting); a language that still has
fewer rows of a class keeps 0.5, the cut of all languages pooled. Language only
selects that threshold; scores see the text alone.

Scoring streams whole texts once. After training, every filter tap times
every embedding row is one table, so a word costs three row look-ups.

Nulls: a null or empty text is scored as no words (all filters at zero); a
null language has threshold 0.5; labels other than 0 and 1 and labels without
a document are not learnt from; a document labelled both ways counts as toxic.
Without rows of both classes all scores are 0. Repeated rows are scored alike.
An empty table gives an empty table. Extra columns are kept; one named like
an added column is replaced by it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.common import hash_share, schema_with, shared_table
from flowlens.llm.textarrays import U64, Words, chunks, mix, text_buffers

SAMPLE_ROWS = 2_000
SAMPLE_BYTES = 16 << 20
BUCKETS = 1 << 15
LEAST_ROWS = 10
#: Steps of a logit in which labelled rows are counted.
STEPS = 256
DIM, FILTERS, WIDTHS, EPOCHS, BATCH, RATE = 12, 4, (1, 2, 3), 8, 32, 0.1
_PREFIXES = (None, 4, 5)


def word_buckets(words: Words) -> np.ndarray:
    """(words, 3): the embedding rows of each word."""
    run = words.sums()
    salts = (U64(0), U64(0x51), U64(0x9D))
    return np.stack([(mix(words.hashes(run, p) + s) % U64(BUCKETS)).astype(np.int32) for p, s in zip(_PREFIXES, salts)], axis=1)


# ---------------------------------------------------------------- the network

def new_model(rng: np.random.Generator) -> dict:
    taps = sum(WIDTHS)
    return {"embed": rng.normal(0, 0.05, (BUCKETS, DIM)), "taps": rng.normal(0, 0.4, (taps, DIM, FILTERS)),
            "bias": np.zeros(len(WIDTHS) * FILTERS), "out": rng.normal(0.5, 0.1, len(WIDTHS) * FILTERS), "out_bias": np.array([-0.5])}


def pooled(tap_values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest value of each filter in each text, and the word where it starts
    (-inf and -1 where a text is shorter than the filter). ``tap_values``:
    (words, taps, filters)."""
    n, count = len(tap_values), np.diff(first)
    best = np.full((len(count), len(WIDTHS) * FILTERS), -np.inf)
    place = np.full(best.shape, -1)
    tap = 0
    for w, width in enumerate(WIDTHS):
        own = np.flatnonzero(count >= width)
        if len(own):
            z = tap_values[:n - width + 1, tap].copy()
            for j in range(1, width):
                z += tap_values[j:n - width + 1 + j, tap + j]
            text = np.repeat(np.arange(len(count)), count)
            z[text[:n - width + 1] != text[width - 1:]] = -np.inf
            cols = slice(w * FILTERS, (w + 1) * FILTERS)
            nonempty = np.flatnonzero(count)
            nonempty = nonempty[first[nonempty] < len(z)]
            top = np.maximum.reduceat(z, first[nonempty], axis=0)
            best[nonempty, cols] = top
            place[nonempty, cols] = 0
        tap += width
    place[~np.isfinite(best)] = -1
    return best, place


def _argmax(z: np.ndarray, first: np.ndarray, own: np.ndarray, width: int) -> np.ndarray:
    return np.stack([first[d] + np.argmax(z[first[d]:first[d + 1] - width + 1], axis=0) for d in own])


def train(rows: list[np.ndarray], labels: np.ndarray, seed: int = 5) -> dict:
    """Fit by Adagrad on batches of texts given as (words, 3) bucket arrays."""
    rng = np.random.default_rng(seed)
    model = new_model(rng)
    memory = {k: np.full(v.shape, 1e-4) for k, v in model.items()}
    weight = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9))
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for start in range(0, len(order), BATCH):
            pick = order[start:start + BATCH]
            _train_batch(model, memory, [rows[i] for i in pick], labels[pick], weight[pick])
    return model


def _train_batch(model: dict, memory: dict, rows: list[np.ndarray], labels: np.ndarray, weight: np.ndarray) -> None:
    words = np.concatenate(rows)
    first = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    count = np.diff(first)
    x = model["embed"][words].sum(axis=1)
    value, places, tap = np.zeros((len(rows), len(WIDTHS) * FILTERS)), [], 0
    for w, width in enumerate(WIDTHS):
        own = np.flatnonzero(count >= width)
        cols = slice(w * FILTERS, (w + 1) * FILTERS)
        at = np.zeros((0, FILTERS), dtype=np.int64)
        if len(own):
            n = len(x) - width + 1
            z = sum(x[j:n + j] @ model["taps"][tap + j] for j in range(width))
            at = _argmax(z, first, own, width)
            value[own, cols] = np.maximum(z[at, np.arange(FILTERS)] + model["bias"][cols], 0)
        places.append((own, at, cols, tap, width))
        tap += width
    score = 1 / (1 + np.exp(-np.clip(value @ model["out"] + model["out_bias"], -30, 30)))
    g = (score - labels) * weight / len(rows)
    grad = {"out": value.T @ g, "out_bias": np.array([g.sum()]), "taps": np.zeros_like(model["taps"]), "bias": np.zeros_like(model["bias"])}
    back = (g[:, None] * model["out"]) * (value > 0)
    touched, pushed = [], []
    for own, at, cols, tap, width in places:
        if not len(own):
            continue
        gz = back[own, cols]
        grad["bias"][cols] = gz.sum(axis=0)
        for j in range(width):
            grad["taps"][tap + j] = np.einsum("bfd,bf->df", x[at + j], gz)
            push = gz[:, :, None] * model["taps"][tap + j].T[None]
            live = gz != 0
            touched.append((at + j)[live])
            pushed.append(push[live])
    for k, v in grad.items():
        memory[k] += v * v
        model[k] -= RATE * v / np.sqrt(memory[k])
    if touched:
        at, push = np.concatenate(touched), np.concatenate(pushed)
        buckets, back_to = np.unique(words[at].ravel(), return_inverse=True)
        total = np.zeros((len(buckets), DIM))
        np.add.at(total, back_to.ravel(), np.repeat(push, words.shape[1], axis=0))
        memory["embed"][buckets] += total * total
        model["embed"][buckets] -= RATE * total / np.sqrt(memory["embed"][buckets])


def tap_table(model: dict) -> np.ndarray:
    """(buckets, taps, filters): each embedding row under each filter tap."""
    return np.einsum("bd,tdf->btf", model["embed"], model["taps"]).astype(np.float32)


def logits(model: dict, table: np.ndarray, buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The network's output before the logistic function, for each text."""
    values = table[buckets[:, 0]] + table[buckets[:, 1]] + table[buckets[:, 2]]
    best, _ = pooled(values, first)
    return np.maximum(best + model["bias"], 0) @ model["out"] + model["out_bias"][0]


def cut_of_counts(low: np.ndarray, high: np.ndarray, rows: np.ndarray, hits: np.ndarray) -> float:
    """The cut with the best F1 (ties: the widest gap), in the middle between two
    neighbouring steps. A step holds values from ``low`` to ``high``: ``rows``, of
    them ``hits`` of class 1."""
    above, found = (np.concatenate([np.cumsum(x[::-1])[::-1], [0]]) for x in (rows, hits))
    f1 = 2 * found / (above + hits.sum())
    cuts = np.concatenate([[low[0] - 1], (low[1:] + high[:-1]) / 2, [high[-1] + 1]])
    gaps = np.concatenate([[0], low[1:] - high[:-1], [0]])
    return float(cuts[max(range(len(cuts)), key=lambda i: (round(f1[i], 12), gaps[i]))])


def best_cut(values: np.ndarray, labels: np.ndarray) -> float:
    """The middle of the widest-scoring gap: the cut with the best F1."""
    steps, at = np.unique(values, return_inverse=True)
    return cut_of_counts(steps, steps, np.bincount(at), np.bincount(at, weights=labels))


# ---------------------------------------------------------------- Spark side

def _sample_buckets(batches):
    for batch in batches:
        out = []
        data, offsets = text_buffers(batch.column("text"))
        for _, _, part, bounds in chunks(data, offsets):
            words = Words(part, bounds)
            buckets = word_buckets(words)
            out += [buckets[a:b].tobytes() for a, b in zip(words.first[:-1], words.first[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("lang"), batch.column("label"), pa.array(out, pa.binary())],
                                         names=["id", "lang", "label", "words"])


def _logits(fitted):
    """Rows (id, lang, value): the network's output before the logistic function."""
    def run(batches):
        model, table = fitted.value
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            value = [np.zeros(0)]
            for _, _, part, bounds in chunks(data, offsets):
                words = Words(part, bounds)
                value.append(logits(model, table, word_buckets(words), words.first))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("lang"), pa.array(np.clip(np.concatenate(value), -30, 30))],
                                             names=["id", "lang", "value"])

    return run



def _histogram(scored: DataFrame) -> DataFrame:
    """Rows (lang, value, label) counted by language and step of the value."""
    step = F.floor(F.col("value") * STEPS).cast("bigint").alias("step")
    return (scored.groupBy("lang", step).agg(F.min("value").alias("low"), F.max("value").alias("high"), F.count(F.lit(1)).alias("rows"),
                                             F.sum("label").cast("bigint").alias("hits")))


def _merged(steps: DataFrame, *by: str) -> DataFrame:
    return steps.groupBy(*by, "step").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("rows").alias("rows"), F.sum("hits").alias("hits"))


def _cut(steps: pa.Table) -> tuple[float, int]:
    """The best cut of a histogram and the rows of its rarer class."""
    low, high, rows, hits = (steps[c].to_numpy() for c in ("low", "high", "rows", "hits"))
    order = np.argsort(low)
    least = int(min(hits.sum(), rows.sum() - hits.sum())) if len(low) else 0
    return (cut_of_counts(low[order], high[order], rows[order], hits[order]) if least else 0.0), least


def _language_cut(steps: pa.Table) -> pa.Table:
    cut, least = _cut(steps)
    return pa.table({"lang": steps["lang"].slice(0, 1), "cut": pa.array([cut]), "least": pa.array([least], pa.int64())})


def _language_cuts(steps: DataFrame, least_rows: int) -> dict[str, float]:
    """Each language's cut, where both classes have ``least_rows``."""
    found = (_merged(steps.where("lang IS NOT NULL"), "lang").groupBy("lang")
             .applyInArrow(_language_cut, "lang string, cut double, least bigint").where(F.col("least") >= least_rows))
    return {r.lang: r.cut for r in found.collect()}  # one row a language


def _cross_fitted(words: list[np.ndarray], label: np.ndarray, fold: np.ndarray, shift: float) -> np.ndarray:
    """Values of the sample's rows of folds 1 to 4, each by a model that has not seen
    its fold, moved so that the model's own best cut is at ``shift``; else nan."""
    value = np.full(len(words), np.nan)
    for f in range(1, 5):
        own = np.flatnonzero(fold == f)
        rest = np.flatnonzero(fold != f)
        if len(set(label[own].tolist())) == 2 and len(set(label[rest].tolist())) == 2:
            model = train([words[i] for i in rest], label[rest])
            table = tap_table(model)
            got = np.concatenate([logits(model, table, words[i], np.array([0, len(words[i])])) for i in own])
            value[own] = np.clip(got - best_cut(got, label[own]) + shift, -30, 30)
    return value


def fit(docs: DataFrame, labels: DataFrame, train_if: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES, least_rows: int = LEAST_ROWS) -> dict | None:
    """The model, its overall shift and its thresholds by language; None without both
    classes. ``train_if``: a condition on ``labels`` for the rows to learn from."""
    order = Window.partitionBy("label").orderBy(F.xxhash64("id"), "id")
    known = (labels.where(train_if & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).cast("bigint").alias("id")).agg(F.max(label_col).cast("int").alias("label")))
    rows = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # two classes
    total = F.when(F.col("label") == 1, F.lit(rows.get(1, 1))).otherwise(F.lit(rows.get(0, 1)))
    chosen = (known.where(hash_share(F.xxhash64("id"), sample_rows, total))
              .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= sample_rows).select("id", "label"))
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                        F.col(lang_col).cast("string").alias("lang"))
    # at most 2 * sample_rows ids: the parameter bounds what is broadcast, sample_bytes what is gathered
    sample = texts.join(F.broadcast(chosen), "id")
    before = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    within = (sample.groupBy("id", "label").agg(F.sum(F.octet_length("text").cast("bigint")).alias("size"))
              .withColumn("before", before).where(F.col("before") < sample_bytes).select("id"))
    rows = (sample.join(F.broadcast(within), "id").select("id", "lang", "label", "text")
            .mapInArrow(_sample_buckets, "id bigint, lang string, label int, words binary")
            .toArrow().sort_by([("id", "ascending"), ("words", "ascending")]))
    label = rows["label"].to_numpy().astype(np.float64)
    fold = mix(rows["id"].to_numpy().view(U64)) % U64(5)
    held = fold == U64(0)
    words = [np.frombuffer(w, np.int32).reshape(-1, 3) for w in rows["words"].to_pylist()]
    if len(set(label[~held].tolist())) < 2:
        return None
    model = train([w for w, h in zip(words, held) if not h], label[~held])
    table = tap_table(model)
    small = {k: v for k, v in model.items() if k != "embed"}
    spark = docs.sparkSession
    learnt = spark.createDataFrame(pa.table({"id": np.unique(rows["id"].to_numpy()[~held])}))  # bounded by the sample
    scored = texts.where(F.col("id").isNotNull()).mapInArrow(_logits(spark.sparkContext.broadcast((small, table))), "id bigint, lang string, value double")
    steps = shared_table(_histogram(scored.join(known.join(F.broadcast(learnt), "id", "left_anti"), "id")), "histogram")
    shift, least = _cut(_merged(steps).toArrow())  # one row a step
    if not least:
        value = np.concatenate([logits(model, table, w, np.array([0, len(w)])) for w in words])
        shift = best_cut(value[~held], label[~held])
    cuts = _language_cuts(steps, least_rows)
    sample_langs = np.array(rows["lang"].to_pylist(), dtype=object)
    rare = ~held & np.array([x is not None and x not in cuts for x in sample_langs], dtype=bool)
    if rare.any():
        value = _cross_fitted(words, label, fold, shift)
        pick = np.flatnonzero(rare & np.isfinite(value))
        if len(pick):
            crossed = spark.createDataFrame(pa.table({"lang": pa.array(sample_langs[pick].tolist(), pa.string()), "value": value[pick],
                                                      "label": pa.array(label[pick].astype(np.int32))}))
            both = steps.unionByName(_histogram(crossed)).where(F.col("lang").isin(sorted(set(sample_langs[pick]))))
            cuts = _language_cuts(both, least_rows) | cuts
    thresholds = {lang: float(min(max(1 / (1 + np.exp(-np.clip(cut - shift, -30, 30))), 0.05), 0.95)) for lang, cut in cuts.items()}
    return {"model": small, "table": table, "shift": shift, "thresholds": thresholds}


def _score(names: list[str], text_col: str, lang_col: str, fitted):
    def run(batches):
        model = fitted.value
        for batch in batches:
            score = np.zeros(batch.num_rows)
            if model is not None:
                data, offsets = text_buffers(batch.column(text_col))
                for first, end, part, bounds in chunks(data, offsets):
                    words = Words(part, bounds)
                    value = logits(model["model"], model["table"], word_buckets(words), words.first)
                    score[first:end] = 1 / (1 + np.exp(-np.clip(value - model["shift"], -30, 30)))
            cuts = model["thresholds"] if model is not None else {}
            threshold = np.array([cuts.get(x, 0.5) for x in batch.column(lang_col).to_pylist()], dtype=np.float64)
            new = {"score": pa.array(score), "predicted": pa.array((score >= 0.5).astype(np.int32)),
                   "threshold": pa.array(threshold), "flagged": pa.array(score >= threshold)}
            yield pa.RecordBatch.from_arrays([new[n] if n in new else batch.column(n) for n in names], names=names)

    return run


def score_toxicity(docs: DataFrame, fitted: dict | None, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``predicted`` (score >= 0.5),
    ``threshold`` (its language's) and ``flagged`` (score >= threshold)."""
    out = schema_with(docs, [("score", "double"), ("predicted", "int"), ("threshold", "double"), ("flagged", "boolean")])
    model = docs.sparkSession.sparkContext.broadcast(fitted)
    return (docs.select(*[F.col(f"`{f.name}`") for f in docs.schema if f.name in out.names])
            .mapInArrow(_score(out.names, text_col, lang_col, model), out))
