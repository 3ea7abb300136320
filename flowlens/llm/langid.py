"""Language identification by cross-parsing entropy.

Text is normalised to a small alphabet: lower-cased letters of the training
texts, one symbol for other letters, one for every run of non-letters. For
each language a suffix automaton of its training text recognises exactly the
substrings of that text. A document is parsed against each automaton: from
the start of a phrase the longest match is followed, and where no transition
is left the next phrase starts. A phrase costs a pointer into the training
text and a symbol, ``log2(n) + log2(alphabet)`` bits; the language with the
fewest bits a symbol wins. The score is one less the ratio of the least cost
to the second least (1 with one language).

Training reads a bounded sample: of each language the ``sample_docs``
documents first by a hash of the id, ``sample_chars`` symbols in all.
Prediction reads whole texts, in pieces of ``PIECE`` symbols that are parsed
side by side (a phrase ends at the end of a piece).

Nulls: a null text, or one without letters, is ``und`` with score 0; rows
with a null language are not learnt from; a null id only keeps a row out of
training. Equal costs go to the first language by name. Repeated rows get
equal predictions. Without training rows every text is ``und``. An empty
table gives an empty table. Extra columns are kept; one named like an added
column is replaced by it.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.common import hash_share, schema_with

SAMPLE_DOCS = 64
SAMPLE_CHARS = 32_768
PIECE = 4_096
#: Symbols parsed side by side at a time.
CHUNK_CHARS = 1 << 22
GAP, OTHER = 0, 1


# ---------------------------------------------------------------- alphabet

def symbol_table(texts: list[str], most: int = 190) -> np.ndarray:
    """Symbol of each code point: the training texts' commonest lower-cased letters."""
    counts: dict[str, int] = {}
    for text in texts:
        for c in text:
            low = c.lower()
            if len(low) == 1 and low.isalpha():
                counts[low] = counts.get(low, 0) + 1
    letters = sorted(counts, key=lambda c: (-counts[c], c))[:most]
    number = {c: i + 2 for i, c in enumerate(letters)}
    out = np.zeros(sys.maxunicode + 1, dtype=np.uint8)
    for point in range(sys.maxunicode + 1):
        c = chr(point)
        if c.isalpha():
            out[point] = number.get(c.lower(), OTHER)
    return out


def symbols(text: str, table: np.ndarray) -> np.ndarray:
    """A text's symbols, runs of non-letters as one."""
    out = table[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    keep = np.ones(len(out), dtype=bool)
    keep[1:] = (out[1:] != GAP) | (out[:-1] != GAP)
    return out[keep]


# ---------------------------------------------------------------- suffix automaton

def suffix_automaton(sequence: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all substrings; state 0 is the start."""
    step, link, length, last = [{}], [-1], [0], 0
    for symbol in sequence:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in step[at]:
            step[at][symbol] = new
            at = link[at]
        if at >= 0:
            to = step[at][symbol]
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                twin = len(step)
                step.append(dict(step[to]))
                length.append(length[at] + 1)
                link.append(link[to])
                link[to] = link[new] = twin
                while at >= 0 and step[at].get(symbol) == to:
                    step[at][symbol] = twin
                    at = link[at]
        last = new
    return step


def automata_table(training: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """All languages' transitions as one array: entry ``state * width + symbol``
    holds ``next state * width``, or 0 where there is none. Also the states'
    offsets of the starts. Entry row 0 is unused."""
    rows, starts = [np.zeros((1, width), np.int32)], []
    base = 1
    for sequence in training:
        step = suffix_automaton(sequence.tolist())
        table = np.zeros((len(step), width), dtype=np.int32)
        for state, to in enumerate(step):
            for symbol, target in to.items():
                table[state, symbol] = (base + target) * width
        rows.append(table)
        starts.append(base * width)
        base += len(step)
    return np.concatenate(rows).ravel(), np.array(starts, dtype=np.int32)


def count_phrases(pieces: list[np.ndarray], table: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """(pieces, languages): phrases of each non-empty piece. All pieces advance
    together, one symbol a step, longest first so that the live ones are a prefix."""
    lengths = np.array([len(p) for p in pieces])
    order = np.argsort(-lengths, kind="stable")
    size = lengths[order]
    matrix = np.zeros((int(size[0]), len(pieces)), dtype=np.uint8)
    for lane, i in enumerate(order):
        matrix[:size[lane], lane] = pieces[i]
    live = np.searchsorted(-size, -np.arange(len(matrix)), side="left")
    n = len(starts)
    first = np.stack([table[s:s + width] for s in starts])
    first[first == 0] = np.broadcast_to(starts[:, None], first.shape)[first == 0]
    phrases = np.ones((n, len(pieces)), dtype=np.int32)
    state = np.repeat(starts[:, None], len(pieces), axis=1)
    for at, m in enumerate(live.tolist()):
        symbol = matrix[at, :m]
        to = table.take(state[:, :m] + symbol)
        over = to == 0
        phrases[:, :m] += over
        state[:, :m] = np.where(over, first[:, symbol], to)
    out = np.empty((len(pieces), n), dtype=np.int64)
    out[order] = phrases.T
    return out


# ---------------------------------------------------------------- the operator

def fit(docs: DataFrame, train_if: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> dict | None:
    """Automata of the languages of the rows that meet ``train_if``; None without any."""
    order = Window.partitionBy("lang").orderBy("place", "id")
    usable = docs.where(train_if & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
    counts = usable.groupBy(F.col(lang_col).cast("string").alias("lang")).agg(F.count(F.lit(1)).alias("n")).collect()  # one row a language
    if not counts:
        return None
    total = F.element_at(F.create_map(*[F.lit(x) for r in counts for x in (r.lang, r.n)]), F.col("lang"))
    rows = (usable.select(F.col(lang_col).cast("string").alias("lang"), F.col(id_col).cast("bigint").alias("id"), F.xxhash64(F.col(id_col).cast("bigint")).alias("place"),
                    F.substring(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 1, sample_chars).alias("text"))
            .where(hash_share(F.col("place"), sample_docs, total))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= sample_docs)
            .select("lang", "rank", "text").toArrow().sort_by([("lang", "ascending"), ("rank", "ascending")]))
    texts: dict[str, list[str]] = {}
    for lang, text in zip(rows["lang"].to_pylist(), rows["text"].to_pylist()):
        texts.setdefault(lang, []).append(text)
    alphabet = symbol_table([t[:sample_chars // 8] for own in texts.values() for t in own])
    width = int(alphabet.max()) + 1
    training = []
    for own in texts.values():
        parts = [symbols(t, alphabet) for t in own]
        share = max(1, sample_chars // len(parts))
        spare = sample_chars - sum(min(len(p), share) for p in parts)
        for i, p in enumerate(parts):  # what short documents leave goes to longer ones
            more = min(max(len(p) - share, 0), spare)
            parts[i], spare = p[:share + more], spare - more
        training.append(np.concatenate(parts))
    table, starts = automata_table(training, width)
    cost = np.array([np.log2(len(t) + 1) + np.log2(width) for t in training])
    return {"langs": list(texts), "alphabet": alphabet, "table": table, "starts": starts, "width": width, "cost": cost}


def predict(texts: list[str], model: dict) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    langs, scores = ["und"] * len(texts), np.zeros(len(texts))
    pieces, owner, length = [], [], np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        own = symbols(text, model["alphabet"]) if text else np.zeros(0, np.uint8)
        if len(own) > 1 or (len(own) and own[0] != GAP):
            length[i] = len(own)
            for at in range(0, len(own), PIECE):
                pieces.append(own[at:at + PIECE])
                owner.append(i)
    if pieces:
        total = np.zeros((len(texts), len(model["langs"])), dtype=np.int64)
        np.add.at(total, np.array(owner), count_phrases(pieces, model["table"], model["starts"], model["width"]))
        for i in np.flatnonzero(length):
            cost = total[i] * model["cost"] / length[i]
            best = int(np.argmin(cost))
            langs[i] = model["langs"][best]
            rest = np.delete(cost, best)
            scores[i] = 1 - cost[best] / rest.min() if len(rest) else 1.0
    return langs, scores


def _identify(names: list[str], text_col: str, model):
    def run(batches):
        fitted = model.value
        for batch in batches:
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            langs, scores = ["und"] * len(texts), [np.zeros(len(texts))]
            if fitted is not None:
                langs, scores, first = [], [], 0
                while first < len(texts):
                    end, chars = first, 0
                    while end < len(texts) and (end == first or chars + len(texts[end]) <= CHUNK_CHARS):
                        chars += len(texts[end])
                        end += 1
                    found, score = predict(texts[first:end], fitted)
                    langs += found
                    scores.append(score)
                    first = end
            new = {"lang_pred": pa.array(langs, pa.string()), "score": pa.array(np.concatenate([np.zeros(0), *scores]))}
            yield pa.RecordBatch.from_arrays([new[n] if n in new else batch.column(n) for n in names], names=names)

    return run


def identify_language(docs: DataFrame, fitted: dict | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    out = schema_with(docs, [("lang_pred", "string"), ("score", "double")])
    model = docs.sparkSession.sparkContext.broadcast(fitted)
    return (docs.select(*[F.col(f"`{f.name}`") for f in docs.schema if f.name in out.names])
            .mapInArrow(_identify(out.names, text_col, model), out))
