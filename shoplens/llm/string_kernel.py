"""Toxicity by a support vector machine on a subsequence string kernel with Nystroem landmarks.

The kernel of two words is the inner product over all subsequences of three characters, each weighted by
DECAY to the length of the stretch it is spread over, stretches of at most SPAN characters, words marked at both
ends, and divided by the norms of the words' weights. A gapped or stuffed insult keeps most of its subsequences. Landmarks give
each word finite features (kernel with the landmarks times the inverse square root of the landmarks' kernel
matrix); a linear machine on these is a weight on subsequences, so a word is scored from its own subsequences.
A document is scored from its highest-scoring words by a logistic model.
"""

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from shoplens.llm.common import id_and_text, staged

DECAY, SPAN = 0.6, 7
LANDMARKS = 256
DOCUMENTS = 20_000  # labelled documents to learn from, those with the smallest hash of their id
WORDS = 6_000  # words of each class to learn from
PURITY, CHANCE = 0.95, 0.01  # telling: such a share of its texts is toxic, by chance in one of 1 / CHANCE corpora
PREFIXES = (4, 5, 6)  # beginnings that are tested beside whole words, as inflected forms are rare one by one
REGULARISATION = 1e-5
MEMORY = 400_000
LONGEST = 64  # longer runs of letters are scored in overlapping stretches of this length

JUNK = re.compile(r"[\W\d_]+")
OFFSETS = np.array([(0, *c) for c in combinations(range(1, SPAN), 2)])
WEIGHTS = DECAY ** (OFFSETS[:, 2] + 1.0)


def spaced_out(words):
    """Runs of three and more one-letter words, each joined to one."""
    found, run = [], []
    if sum(map((1).__eq__, map(len, words))) > 2:
        for w in [*words, ".."]:
            if len(w) == 1 and w.isalpha():
                run.append(w)
            else:
                if len(run) > 2:
                    found.append("".join(run))
                run = []
    return found


def units(text):
    """The different units of a text: letters of each space-separated word, and runs of spaced-out letters joined."""
    words = text.lower().split()
    found = {JUNK.sub("", w) for w in set(words)} | set(spaced_out(words))
    found.discard("")
    return found


def stretches(unit):
    if len(unit) <= LONGEST:
        return [unit]
    return [unit[i:i + LONGEST] for i in range(0, len(unit) - LONGEST // 2, LONGEST // 2)]


def subsequences(words):
    """(word number, key, weight) of all spread-out triples of characters of all words, and the words' norms."""
    marked = [f"\x02{w}\x03" for w in words]
    lengths = np.array([len(w) for w in marked])
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    owner = np.repeat(np.arange(len(words)), lengths)
    room = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))  # characters from here to the end
    owners, keys, weights = [], [], []
    for (_, b, c), weight in zip(OFFSETS, WEIGHTS):
        at = np.flatnonzero(room > c)
        owners.append(owner[at])
        keys.append((codes[at] << 42) | (codes[at + b] << 21) | codes[at + c])
        weights.append(np.full(len(at), weight))
    owners, keys, weights = map(np.concatenate, (owners, keys, weights))
    return owners, keys, weights, np.sqrt(np.bincount(owners, weights * weights, len(words)))


def kernel(left, right):
    """Kernel of two lists of words, from the subsequences that they share."""
    (a, ak, aw, an), (b, bk, bw, bn) = subsequences(left), subsequences(right)
    out = np.zeros((len(left), len(right)))
    order = np.argsort(bk, kind="stable")
    b, bk, bw = b[order], bk[order], bw[order]
    low, high = np.searchsorted(bk, ak, "left"), np.searchsorted(bk, ak, "right")
    count = high - low
    of = np.repeat(np.arange(len(ak)), count)
    place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
    np.add.at(out, (a[of], b[place]), aw[of] * bw[place])
    return out / np.outer(np.maximum(an, 1e-12), np.maximum(bn, 1e-12))


def _slots(keys):
    return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)


def _machine(features, sign, weight):
    """Linear machine with squared hinge loss, by Newton steps on the rows inside the margin."""
    x = np.hstack([features, np.ones((len(features), 1))])
    w = np.zeros(x.shape[1])
    ridge = REGULARISATION * np.diag([*np.ones(features.shape[1]), 0.0])
    for _ in range(30):
        inside = sign * (x @ w) < 1
        part, own = x[inside], weight[inside][:, None]
        fresh = np.linalg.solve(part.T @ (own * part) + ridge + 1e-9 * np.eye(len(w)), part.T @ (own[:, 0] * sign[inside]))
        if np.allclose(fresh, w, atol=1e-8):
            break
        w = fresh
    return w[:-1], w[-1]


class WordMachine:
    """Decision values of words. `toxic`, `clean`: lists of words."""

    def __init__(self, toxic, clean, seed=0):
        rng = np.random.default_rng(seed)
        half = LANDMARKS // 2
        pick = lambda words: [words[i] for i in sorted(rng.permutation(len(words))[:half])]
        marks = pick(toxic) + pick(clean)
        value, vector = np.linalg.eigh(kernel(marks, marks))
        good = value > 1e-6
        root = vector[:, good] / np.sqrt(value[good])
        features = np.vstack([kernel(words[i:i + 500], marks) @ root for words in (toxic, clean)
                              for i in range(0, len(words), 500)])
        sign = np.repeat([1.0, -1.0], [len(toxic), len(clean)])
        weight = np.repeat([0.5 / len(toxic), 0.5 / len(clean)], [len(toxic), len(clean)])
        line, self.bias = _machine(features, sign, weight)
        # the machine as a weight on each subsequence of a landmark
        owner, key, w, norm = subsequences(marks)
        share = (root @ line)[owner] * w / norm[owner]
        self.keys, place = np.unique(key, return_inverse=True)
        self.shares = np.bincount(place, share, len(self.keys))
        slots = _slots(self.keys)
        self.place = np.zeros(1 << 20, np.int32)  # of the key of each slot, from 1; 0: no landmark has it
        self.place[slots] = np.arange(1, len(slots) + 1)
        # keys that share a slot with another one are looked up by search
        self.crowded = np.zeros(1 << 20, bool)
        self.crowded[slots] = np.bincount(slots.astype(np.int64), minlength=1 << 20)[slots] > 1
        self.memory = {}  # decisions of words, filled where the machine is used

    def decide(self, words):
        owner, key, w, norm = subsequences(words)
        slots = _slots(key)
        met = np.flatnonzero(self.place[slots])
        owner, key, w, slots = owner[met], key[met], w[met], slots[met]
        place = self.place[slots] - 1
        several = np.flatnonzero(self.crowded[slots])
        place[several] = np.minimum(np.searchsorted(self.keys, key[several]), len(self.keys) - 1)
        share = np.where(self.keys[place] == key, self.shares[place], 0.0)
        return np.bincount(owner, w * share, len(words)) / np.maximum(norm, 1e-12) + self.bias


class Scorer:
    """Decisions of space-separated words with a memory, and the two highest of a text."""

    def __init__(self, machine):
        self.machine, self.known = machine, machine.memory

    def _learn(self, words):
        words = list(words)
        for i in range(0, len(words), 20_000):
            part = words[i:i + 20_000]
            pieces = [stretches(JUNK.sub("", w)) for w in part]
            sizes = np.array([len(p) for p in pieces])
            values = self.machine.decide([s for p in pieces for s in p])
            best = np.maximum.reduceat(values, np.r_[0, np.cumsum(sizes)[:-1]])
            # what holds no letter says nothing
            self.known.update((w, v if p[0] else self.machine.bias) for w, v, p in zip(part, best.tolist(), pieces))

    def highest(self, text):
        words = text.lower().split()
        own = set(words)
        if not own:
            return self.machine.bias, self.machine.bias
        own.update(spaced_out(words))
        new = own.difference(self.known)
        if new:
            if len(self.known) + len(new) > MEMORY:
                self.known.clear()
                new = own
            self._learn(new)
        best = sorted(map(self.known.__getitem__, own))[-2:]
        return best[-1], best[0] if len(best) > 1 else self.machine.bias


def _logistic(x, y):
    """Weights of a small logistic model by Newton steps, both classes alike in sum."""
    x = np.hstack([x, np.ones((len(x), 1))])
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 1e-5 * np.eye(len(w)),
                               x.T @ (weight * (y - p)) - 1e-5 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Model:
    """`machine` None: all texts get the share of toxic labels (one class, or no telling words)."""

    def __init__(self, machine=None, line=None, share=0.0):
        self.machine, self.line, self.share = machine, line, share

    def scores(self, highest):
        if self.machine is None:
            return np.full(len(highest), min(self.share, 1.0))
        x = np.hstack([highest, np.ones((len(highest), 1))]) @ self.line
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _tell(batches):
    """Rows (unit, toxic, mark), each unit of a text once: `mark` is a hash of the words around its first place.

    Copies and near copies of a text repeat a word between the same neighbours; a word that is telling by itself
    stands between different ones.
    """
    for batch in batches:
        rows = []
        for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
            words = text.lower().split()
            around = ["", *words, ""]
            places = {}
            for i, word in enumerate(words):
                if word not in places:
                    places[word] = i
            marks = {}
            for word, i in places.items():
                marks.setdefault(JUNK.sub("", word), f"{around[i]} {around[i + 2]}")
            rows += [(u, toxic, xxhash.xxh3_64_intdigest(marks.get(u, " ".join(words[:5]))) - (1 << 63))
                     for u in units(text) if len(u) <= LONGEST]
        columns = list(zip(*rows)) if rows else [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()),
                                          pa.array(columns[2], pa.int64())], ["unit", "toxic", "mark"])


def held_out(doc_id="doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def _classes(counted, share, words):
    """Words of the two classes from rows (unit, t, c): different surroundings in toxic and in clean texts.

    A word or beginning is telling where its texts are more often toxic than the share of toxic texts explains
    (Chernoff bound on the binomial tail, against as many tests as there are words). Words with a telling form
    that no clean text holds are one class; the other are the commonest words of clean texts and as many others.
    """
    total = counted.count()
    forms = F.array(F.concat("unit", F.lit("$")), *[
        F.when(F.length("unit") >= n, F.substring("unit", 1, n)) for n in PREFIXES])
    by_form = counted.select("unit", "t", "c", F.explode(F.array_compact(forms)).alias("form"))
    n, rate = F.col("t") + F.col("c"), F.lit(min(max(share, 1e-6), 1 - 1e-6))
    p = F.col("t") / n
    surprise = n * (p * F.log(p / rate) + F.when(p < 1, (1 - p) * F.log((1 - p) / (1 - rate))).otherwise(0.0))
    telling = (by_form.groupBy("form").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
               .where((F.col("t") > 0) & (p >= PURITY) & (p > rate)
                      & (surprise >= float(np.log(max(total, 1) / CHANCE)))).select("form"))
    toxic = (by_form.where(F.col("c") == 0).join(telling, "form").groupBy("unit").agg(F.max("t").alias("t"))
             .orderBy(F.desc("t"), "unit").limit(words).collect())
    met = counted.where(F.col("c") > 0)
    clean = (met.orderBy(F.desc("c"), "unit").limit(words // 2).collect()
             + met.orderBy(F.xxhash64("unit"), "unit").limit(words // 2).collect())
    return [r["unit"] for r in toxic], sorted({r["unit"] for r in clean})


def _mistaken(counted, machine, words):
    """Words of clean texts that score highest: what a second fit has to tell apart."""
    shared = counted.sparkSession.sparkContext.broadcast(machine)

    def run(batches):
        for batch in batches:
            part = batch["unit"].to_pylist()
            value = shared.value.decide(part) if part else []
            yield pa.RecordBatch.from_arrays([batch["unit"], pa.array(value, pa.float64())], ["unit", "value"])

    found = counted.where(F.col("c") > 0).select("unit").mapInArrow(run, "unit string, value double")
    return [r["unit"] for r in found.orderBy(F.desc("value"), "unit").limit(words // 2).collect()]


def learn(docs, labels, documents=DOCUMENTS, words=WORDS):
    """Fits on labelled rows outside the held-out fold; of these on `documents` with the smallest hash of their id.

    Rows with a null id or a null label teach nothing; of several labels of one id the highest counts. Words are
    counted by different surroundings, so copies count once; the telling ones are one class, words of clean texts
    the other. The logistic model of a document's two highest words is fitted on the same documents.
    """
    one = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    picked = (one.where(~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(documents))
    # at most `documents` short rows: texts are picked where they are read
    rows = id_and_text(docs).join(F.broadcast(picked), "doc_id").select("doc_id", "text", "toxic")
    shares = rows.agg(F.count("*"), F.sum("toxic")).first()
    share = (shares[1] or 0) / shares[0] if shares[0] else 0.0
    counted = (rows.select("text", "toxic").mapInArrow(_tell, "unit string, toxic int, mark long")
               .groupBy("unit").agg(F.count_distinct(F.when(F.col("toxic") == 1, F.col("mark"))).alias("t"),
                                    F.count_distinct(F.when(F.col("toxic") == 0, F.col("mark"))).alias("c")))
    counted = staged(counted, "words")
    toxic, clean = _classes(counted, share, words)
    if not toxic or not clean or share in (0.0, 1.0):
        return Model(share=share)
    machine = WordMachine(toxic, clean)
    clean = sorted({*clean, *_mistaken(counted, machine, words)})
    machine = WordMachine(toxic, clean)
    seen = _highest(rows, machine, "doc_id long, toxic int, x double, y double", ("doc_id", "toxic")).toPandas()
    line = _logistic(seen[["x", "y"]].to_numpy(), seen["toxic"].to_numpy(dtype=float))
    return Model(machine, line, share)


def _highest(rows, machine, schema, kept):
    shared = rows.sparkSession.sparkContext.broadcast(machine)  # a weight for each subsequence of a landmark

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            best = [scorer.highest(t) for t in batch["text"].to_pylist()]
            x, y = zip(*best) if best else ((), ())
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in kept], pa.array(x, pa.float64()),
                                              pa.array(y, pa.float64())], [*kept, "x", "y"])

    return rows.mapInArrow(run, schema)


def score(docs, labels, model=None):
    """(doc_id, held_out, score, predicted) of every row.

    Only the text is scored: null and empty texts have no words and get the lowest score the model gives; long
    ones are scored whole. Repeated rows stay, a null id is not held out, other columns are ignored. Without
    labels of both classes the score is the share of toxic labels (0 without any).
    """
    model = model or learn(docs, labels)
    rows = id_and_text(docs)
    if model.machine is None:
        found = rows.select("doc_id", F.lit(float(model.share)).alias("score"))
    else:
        a, b, c = map(float, model.line)
        found = _highest(rows, model.machine, "doc_id long, x double, y double", ("doc_id",)).select(
            "doc_id", (1 / (1 + F.exp(-(F.col("x") * a + F.col("y") * b + c)))).alias("score"))
    return found.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs, labels, model=None):
    """The documents whose text is not predicted toxic: same columns, rows in place, nothing joined."""
    model = model or learn(docs, labels)
    if model.machine is None:
        return docs if model.share < 0.5 else docs.limit(0)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def run(batches):
        own = shared.value
        scorer = Scorer(own.machine)
        for batch in batches:
            best = np.array([scorer.highest(t or "") for t in batch.column(place).to_pylist()]).reshape(-1, 2)
            yield batch.filter(pa.array(own.scores(best) < 0.5))

    return docs.mapInArrow(run, docs.schema)
