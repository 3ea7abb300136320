"""Personal data: base patterns and a semi-Markov conditional random field.

Base spans come from four patterns (email, ip, card, phone; ``base_spans``)
and always stay. The model adds spans that the patterns miss, such as phone
numbers without a plus sign.

The model works on regions: neighbouring words (one blank apart) that hold a
digit or ``@``; every other word can hold no span. A region is cut into atoms
(digit runs, letter runs, single other characters). A candidate segment is up
to ``MOST_ATOMS`` atoms, scored by features of the whole span: loose formats,
digit counts and groups, check digits, its ends and its surroundings. Dynamic
programming over all segmentations gives the partition function in training
and the best joint choice of boundaries and types in decoding; atoms outside
an entity score 0.

Training maximises the regularised likelihood on a bounded sample of
``sample_regions`` regions, chosen by hash from all documents and labelled by
the base patterns. Every labelled phone number also serves once without its
plus sign, so the model learns the format and not the sign.

Nulls: a null text is empty; a null id is an id like others. Repeated rows
get equal spans. Without any region in the sample nothing is added. An empty
table gives an empty table. Extra columns are kept; one named like an added
column is replaced by it. Long texts are searched whole. A blank-free run with a
digit is decoded at once, at some 3 kB a character of it: 300 kB in one word
take about 1 GB of a task's memory.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import hash_share, schema_with, shared_table

KINDS = ("email", "ip", "card", "phone")
SAMPLE_REGIONS = 1_500
MOST_ATOMS = 16
EPOCHS, RATE, DECAY, ENTITY_BIAS = 6, 0.3, 1e-3, -4.0
#: Longest region to learn from; all are searched.
TRAIN_CHARS = 160

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANCHOR = re.compile(r"[0-9@]")
_REGION_WORD = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*")
_ATOM = re.compile(r"[0-9]+|[^\W\d_]+|.", re.DOTALL)


# ---------------------------------------------------------------- base patterns

def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the address pattern, found from each ``@`` outwards."""
    out, at, free = [], text.find("@"), 0
    while at >= 0:
        start = at - (len(text[free:at]) - len(text[free:at].rstrip(_LOCAL)))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        free = domain.end() if domain else at + 1
        if domain:
            out.append((start, free))
        at = text.find("@", free)
    return out


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Base spans by kind, in order: (start, end) in code points."""
    found = {k: [] for k in KINDS}
    if "@" in text:
        found["email"] = emails(text)
    if _ANCHOR.search(text):
        found["ip"] = [m.span() for m in _IP.finditer(text) if _octets(m[0])]
        found["card"] = [m.span() for m in _CARD.finditer(text) if 13 <= len(d := digits_of(m[0])) <= 19 and luhn(d)]
        if "+" in text:
            found["phone"] = [m.span() for m in _PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return found


def regions(text: str) -> list[tuple[int, int]]:
    """Runs of words with a digit or ``@``, one blank apart."""
    out: list[tuple[int, int]] = []
    if _ANCHOR.search(text):
        for m in _REGION_WORD.finditer(text):
            if out and m.start() == out[-1][1] + 1 and text[out[-1][1]] == " ":
                out[-1] = (out[-1][0], m.end())
            else:
                out.append(m.span())
    return out


# ---------------------------------------------------------------- features of whole spans

_LOOSE = (("email", re.compile(r"[^\W_][\w.%+-]*@\w[\w-]*(?:\.\w[\w-]*)+")), ("dots", re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")),
          ("digits", re.compile(r"[0-9]+")), ("spaced", re.compile(r"[0-9]{2,6}(?:[ -][0-9]{2,7})+")),
          ("phone", re.compile(r"\+?(?:[0-9]{1,3}[ .-]?)?\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}(?:[ .-][0-9]{2,4})*")))


def _side(c: str) -> str:
    return "end" if not c else "digit" if c.isdigit() else "letter" if c.isalpha() else "blank" if c.isspace() else c if c in "+@.-_" else "other"


def span_features(text: str, before: str, after: str) -> list[str]:
    """Features of one candidate span; none where it cannot be an entity."""
    if not (text[-1].isalnum() and (text[0].isalnum() or text[0] in "+(")) or not _ANCHOR.search(text):
        return []
    digits = digits_of(text)
    groups = [str(len(g)) for g in re.findall("[0-9]+", text)]
    loose = [name for name, pattern in _LOOSE if pattern.fullmatch(text)]
    out = ["bias", f"digits={min(len(digits), 20)}", f"groups={'-'.join(groups[:6])}", f"before={_side(before)}", f"after={_side(after)}",
           f"first={_side(text[0])}", f"loose={'+'.join(loose) or 'none'}", f"letters={any(c.isalpha() for c in text)}", f"at={text.count('@') if text.count('@') < 2 else 2}"]
    if 13 <= len(digits) <= 19:
        out.append(f"luhn={luhn(digits)}")
    if "dots" in loose:
        out.append(f"octets={_octets(text)}")
    return out


class Lattice:
    """The candidate segments of a region: ``segments[end]`` holds (start, features)."""

    def __init__(self, text: str):
        self.bounds = [0] + [m.end() for m in _ATOM.finditer(text)]
        self.n = len(self.bounds) - 1
        self.segments: list[list[tuple[int, list[str]]]] = [[] for _ in range(self.n + 1)]
        for end in range(1, self.n + 1):
            for start in range(max(0, end - MOST_ATOMS), end):
                a, b = self.bounds[start], self.bounds[end]
                features = span_features(text[a:b], text[a - 1:a], text[b:b + 1])
                if features:
                    self.segments[end].append((start, features))


def _scores(features: list[str], weights: dict[str, list[float]]) -> list[float]:
    total = [ENTITY_BIAS] * len(KINDS)
    for f in features:
        w = weights.get(f)
        if w is not None:
            total = [t + x for t, x in zip(total, w)]
    return total


def _log_add(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def gradient(lattice: Lattice, gold: set[tuple[int, int, int]], weights: dict[str, list[float]]) -> dict[str, list[float]]:
    """Observed less expected feature counts. ``gold``: (start, end, kind) in atoms."""
    n = lattice.n
    scored = [[(start, features, _scores(features, weights)) for start, features in own] for own in lattice.segments]
    ahead = [0.0] * (n + 1)
    for end in range(1, n + 1):
        ahead[end] = _log_add([ahead[end - 1]] + [ahead[start] + s for start, _, scores in scored[end] for s in scores])
    back = [0.0] * (n + 1)
    after: list[list[tuple[int, list[float]]]] = [[] for _ in range(n + 1)]
    for end in range(1, n + 1):
        for start, _, scores in scored[end]:
            after[start].append((end, scores))
    for start in range(n - 1, -1, -1):
        back[start] = _log_add([back[start + 1]] + [back[end] + s for end, scores in after[start] for s in scores])
    out: dict[str, list[float]] = {}
    for end in range(1, n + 1):
        for start, features, scores in scored[end]:
            push = [float((start, end, k) in gold) - math.exp(ahead[start] + s + back[end] - ahead[n]) for k, s in enumerate(scores)]
            if max(map(abs, push)) > 1e-6:
                for f in features:
                    own = out.setdefault(f, [0.0] * len(KINDS))
                    for k, p in enumerate(push):
                        own[k] += p
    return out


def decode(text: str, weights: dict[str, list[float]]) -> list[tuple[int, int, str]]:
    """The best segmentation's entities: (start, end, kind) in code points of ``text``."""
    lattice = Lattice(text)
    best: list[tuple[float, int, int]] = [(0.0, 0, -1)]
    for end in range(1, lattice.n + 1):
        top = (best[end - 1][0], end - 1, -1)
        for start, features in lattice.segments[end]:
            for k, s in enumerate(_scores(features, weights)):
                if best[start][0] + s > top[0]:
                    top = (best[start][0] + s, start, k)
        best.append(top)
    out, end = [], lattice.n
    while end:
        _, start, kind = best[end]
        if kind >= 0:
            out.append((lattice.bounds[start], lattice.bounds[end], KINDS[kind]))
        end = start
    return out[::-1]


def labelled(text: str) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """A region with its base spans (the longer of overlapping ones), and the
    same without the plus sign of a phone number."""
    spans = sorted(((a, b, k) for k, own in base_spans(text).items() for a, b in own), key=lambda s: (s[0] - s[1], s))
    kept: list[tuple[int, int, str]] = []
    for a, b, k in spans:
        if all(b <= x or a >= y for x, y, _ in kept):
            kept.append((a, b, k))
    out = [(text, sorted(kept))]
    for a, b, k in kept:
        if k == "phone":
            out.append((text[:a] + text[a + 1:], sorted((x - (x > a), y - (y > a), z) for x, y, z in kept)))
            break
    return out


def train(samples: list[str]) -> dict[str, list[float]]:
    """Weights by feature, one number a kind: Adagrad on the likelihood."""
    examples = []
    for text in samples:
        for own, spans in labelled(text):
            lattice = Lattice(own)
            at = {b: i for i, b in enumerate(lattice.bounds)}
            gold = {(at[a], at[b], KINDS.index(k)) for a, b, k in spans if a in at and b in at and at[b] - at[a] <= MOST_ATOMS}
            if len(gold) == len(spans):
                examples.append((lattice, gold))
    weights: dict[str, list[float]] = {}
    memory: dict[str, list[float]] = {}
    for _ in range(EPOCHS):
        for lattice, gold in examples:
            for f, g in gradient(lattice, gold, weights).items():
                w, m = weights.setdefault(f, [0.0] * len(KINDS)), memory.setdefault(f, [1e-2] * len(KINDS))
                for k, x in enumerate(g):
                    x -= DECAY * w[k]
                    m[k] += x * x
                    w[k] += RATE * x / math.sqrt(m[k])
    return weights


# ---------------------------------------------------------------- Spark side

def _sample(batches):
    for batch in batches:
        found = [t[a:b] for t in batch.column(0).to_pylist() if t for a, b in regions(t) if b - a <= TRAIN_CHARS]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([xxhash.xxh64_intdigest(r.encode()) >> 1 for r in found], pa.int64())],
                                         names=["region", "place"])


def fit(docs: DataFrame, text_col: str = "text", sample_regions: int = SAMPLE_REGIONS) -> dict[str, list[float]]:
    """Weights learnt from a bounded sample of distinct regions."""
    every = shared_table(docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(_sample, "region string, place bigint")
                         .dropDuplicates(), "regions")
    found = (every.where(hash_share(F.xxhash64("place"), sample_regions, F.lit(max(every.count(), 1))))
             .orderBy(F.xxhash64("place"), "region").limit(sample_regions).toArrow())
    return train(found["region"].to_pylist())


def find_spans(text: str, weights: dict[str, list[float]], memory: dict[str, list]) -> tuple[dict[str, list], dict[str, list]]:
    """Base spans and added spans by kind."""
    base, added = base_spans(text), {k: [] for k in KINDS}
    taken = [s for own in base.values() for s in own]
    for a, b in regions(text):
        region = text[a:b]
        found = memory.get(region)
        if found is None:
            if len(memory) > 20_000:
                memory.clear()
            found = memory[region] = decode(region, weights)
        for x, y, kind in found:
            if not any(a + x < end and start < a + y for start, end in taken):
                added[kind].append((a + x, a + y))
    return base, added


def spans_text(spans: dict[str, list[tuple[int, int]]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in sorted(spans[k]))


def _find(names: list[str], text_col: str, weights):
    def run(batches):
        learnt, memory = weights.value, {}
        for batch in batches:
            new: dict[str, list] = {n: [] for n, _ in ADDED}
            for text in batch.column(text_col).to_pylist():
                base, added = find_spans(text or "", learnt, memory)
                for k in KINDS:
                    new[f"n_{k}"].append(len(base[k]))
                new["n_added"].append(sum(map(len, added.values())))
                new["base_spans"].append(spans_text(base))
                new["spans"].append(spans_text({k: base[k] + added[k] for k in KINDS}))
            kinds = {n: pa.string() if kind == "string" else pa.int64() for n, kind in ADDED}
            yield pa.RecordBatch.from_arrays([pa.array(new[n], kinds[n]) if n in new else batch.column(n) for n in names], names=names)

    return run


ADDED = [*((f"n_{k}", "bigint") for k in KINDS), ("n_added", "bigint"), ("base_spans", "string"), ("spans", "string")]


def find_personal_data(docs: DataFrame, weights: dict[str, list[float]], text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_<kind>`` (base spans), ``n_added``, ``base_spans`` and
    ``spans`` (all), as ``kind:start:end`` in code points, end exclusive."""
    out = schema_with(docs, ADDED)
    model = docs.sparkSession.sparkContext.broadcast(weights)
    return (docs.select(*[F.col(f"`{f.name}`") for f in docs.schema if f.name in out.names])
            .mapInArrow(_find(out.names, text_col, model), out))
