"""Secret scans: fixed patterns, and a probabilistic automaton learnt from what they find.

Values that the patterns find are labelled credentials. Their prefix tree, over classes of characters, is folded
into an automaton: two states merge when their outgoing and stopping frequencies differ by no more than a
Hoeffding bound, and the same holds for all states that follow. Every other run of credential characters is then
scored by its likelihood under the automaton against a model of ordinary text.
"""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from shoplens.llm.common import id_and_text

# The contract's patterns, in the order in which kinds are listed
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run is taken whole, so this is "runs, then 24 or more"
KINDS = ("assign", "access", "hex", "format")
ASSIGN_VALUE, ACCESS_LENGTH = 6, 20

WORDS = ("passw", "secret", "token", "api")  # each assignment holds one of them in lower case
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]+")  # runs that the automaton scores, the alphabet of assigned values
SAMPLE = 1000  # distinct labelled credentials of each kind to learn from, those with the smallest hash
SAMPLE_LENGTH = 256  # characters of a credential to learn from, at most
ALPHABET = " ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"  # the space: any other character
PLACES = np.array([max(0, ALPHABET.find(chr(i))) for i in range(129)])
ALPHA = 0.05  # a merge is refused where frequencies differ with this confidence
MARGIN = 0.5  # likelihood ratio a character, in nats, that a span needs at least
LEAST = 0.02  # share of labelled credentials that may fall below the bound that is learnt


def symbols(value):
    """Character classes: digits, hex letters, other lower case, upper case; any other character is itself."""
    return ["d" if c in "0123456789" else "h" if c in "abcdef" else "l" if c.islower() else "U" if c.isupper() else c
            for c in value]


SPREAD = {"d": math.log(10), "h": math.log(6), "l": math.log(20), "U": math.log(26)}  # inside a class: uniform


def base_spans(text):
    """[(start, kind place, end, value)] of the fixed patterns, leftmost non-overlapping in each kind."""
    found = []
    lower = text.lower()
    if any(w in lower for w in WORDS):
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found)


class Automaton:
    """Deterministic, learnt by merging states of the prefix tree."""

    def __init__(self, values, alpha=ALPHA):
        self.alpha = alpha
        self.passed, self.stopped, self.next = [0], [0], [{}]
        for value, count in values:
            self._grow(symbols(value), count)
        self._fold()

    def _grow(self, word, count):
        state = 0
        for s in word:
            self.passed[state] += count
            if s not in self.next[state]:
                self.next[state][s] = len(self.next)
                self.next.append({})
                self.passed.append(0)
                self.stopped.append(0)
            state = self.next[state][s]
        self.passed[state] += count
        self.stopped[state] += count

    def _moves(self, state):
        return {s: self.passed[t] for s, t in self.next[state].items()}

    def _compatible(self, a, b):
        """Are all frequencies of the two states, and of what follows, within the bound? No recursion: long words."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self.passed[a], self.passed[b]
            if not n or not m:
                continue
            bound = math.sqrt(0.5 * math.log(2 / self.alpha)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            out_a, out_b = self.taken[a], self._moves(b)
            if abs(self.stopped[a] / n - self.stopped[b] / m) > bound:
                return False
            for s in out_a.keys() | out_b.keys():
                if abs(out_a.get(s, 0) / n - out_b.get(s, 0) / m) > bound:
                    return False
                if s in self.next[a] and s in self.next[b]:
                    todo.append((self.next[a][s], self.next[b][s]))
        return True

    def _merge(self, a, b):
        """Folds the tree below b into the automaton at a."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.passed[a] += self.passed[b]
            self.stopped[a] += self.stopped[b]
            for s, t in self.next[b].items():
                self.taken[a][s] = self.taken[a].get(s, 0) + self.passed[t]
                if s in self.next[a]:
                    todo.append((self.next[a][s], t))
                else:
                    self.next[a][s] = t

    def _fold(self):
        """Red states are kept; a blue state (one step beyond) joins the first compatible red one or turns red."""
        self.taken = [self._moves(s) for s in range(len(self.next))]
        red, blue = [0], sorted(self.next[0].items())
        source = {t: (0, s) for s, t in blue}
        blue = [t for _, t in blue]
        kept = {0}
        while blue:
            b = blue.pop(0)
            for a in red:
                if self._compatible(a, b):
                    p, s = source[b]
                    self.next[p][s] = a
                    self._merge(a, b)
                    break
            else:
                red.append(b)
                kept.add(b)
            waiting = set(blue)
            for a in red:
                for s, t in sorted(self.next[a].items()):
                    if t not in kept and t not in waiting:
                        blue.append(t)
                        waiting.add(t)
                        source[t] = (a, s)
        self.states = red
        self.arcs = {a: {s: (t, math.log(self.taken[a][s] / self.passed[a])) for s, t in self.next[a].items()}
                     for a in red}
        self.end = {a: math.log(self.stopped[a] / self.passed[a]) if self.stopped[a] else None for a in red}
        del self.taken, self.passed, self.stopped, self.next

    def log_likelihood(self, value):
        """Of the characters and of stopping after them; None where the automaton has no such path."""
        state, total = 0, 0.0
        for s in symbols(value):
            step = self.arcs[state].get(s)
            if step is None:
                return None
            state = step[0]
            total += step[1] - SPREAD.get(s, 0.0)
        return None if self.end[state] is None else total + self.end[state]


class Ordinary:
    """Pairs of characters in ordinary text, smoothed; `counts` has (first, second, n), the space for all that is
    outside of the alphabet."""

    def __init__(self, counts):
        pairs, single = Counter(), Counter()
        for first, second, n in counts:
            pairs[first, second] += n
            single[first] += n
        self.pairs = {k: math.log((n + 0.5) / (single[k[0]] + 33)) for k, n in pairs.items()}
        self.rare = {c: math.log(0.5 / (n + 33)) for c, n in single.items()}
        self.unseen = math.log(1 / 66)

    def log_likelihood(self, value):
        word = f" {value} "
        return sum(self.pairs.get(p) or self.rare.get(p[0], self.unseen) for p in zip(word, word[1:]))


class Formats:
    """One automaton a kind of labelled credential, the model of ordinary text, and the bound that is learnt."""

    def __init__(self, labelled, counts):
        by_kind = defaultdict(list)
        for kind, value, count in labelled:
            by_kind[kind].append((value, count))
        self.automata = [Automaton(v) for _, v in sorted(by_kind.items())]
        self.ordinary = Ordinary(counts)
        scores = sorted(s for v in by_kind.values() for x, _ in v if (s := self.score(x)) is not None)
        self.bound = max(MARGIN, scores[int(LEAST * len(scores))]) if scores else None

    def score(self, value):
        """Log likelihood ratio a character; None where no automaton can write the value."""
        found = [x for a in self.automata if (x := a.log_likelihood(value)) is not None]
        return (max(found) - self.ordinary.log_likelihood(value)) / len(value) if found else None

    def spans(self, text, base):
        """Runs outside the base spans, and what is left of a run beside one, that look like a credential."""
        if self.bound is None:
            return []
        found = []
        for m in CANDIDATE.finditer(text):
            if m.end() - m.start() < ASSIGN_VALUE:
                continue
            at, parts = m.start(), []
            for start, _, end, _ in base:
                if at < end and start < m.end():
                    parts.append((at, start))
                    at = end
            for start, end in [*parts, (at, m.end())]:
                if end - start < ASSIGN_VALUE:
                    continue
                value = text[start:end]
                if value.isalpha() and (value.islower() or value[1:].islower()):
                    continue  # one written word: a letter run of one case holds no format
                score = self.score(value)
                if score is not None and score >= self.bound:
                    found.append((start, 3, end, value))
        return found


def _character_pairs(batches):
    """Rows (pair, n) of all texts of a task, summed up; a text begins and ends with a space."""
    size = len(ALPHABET)
    total = np.zeros(size * size, np.int64)
    for batch in batches:
        for text in batch["text"].to_pylist():
            codes = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), "<u4")
            place = PLACES[np.minimum(codes, 128)]
            total += np.bincount(place[:-1] * size + place[1:], minlength=size * size)
    total[0] = 0  # between two spaces there is no word
    met = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(total[met], pa.int64())], ["pair", "n"])


def ordinary_counts(rows):
    """(first, second, n) of the character pairs of all texts: at most one row for each pair of the alphabet."""
    found = (rows.select("text").mapInArrow(_character_pairs, "pair int, n long")
             .groupBy("pair").agg(F.sum("n").alias("n")).collect())
    return sorted((*map(ALPHABET.__getitem__, divmod(r["pair"], len(ALPHABET))), r["n"]) for r in found)


def learn(docs, sample=SAMPLE):
    """Labelled credentials and character pairs of the whole table, counted; a bounded number of distinct
    credentials is learnt from."""
    rows = id_and_text(docs)

    def labelled(batches):
        for batch in batches:
            found = [(k, v) for text in batch["text"].to_pylist() for _, k, _, v in base_spans(text)]
            kinds, values = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(values, pa.string())],
                                             ["kind", "value"])

    counted = (rows.select("text").mapInArrow(labelled, "kind int, value string").where(F.length("value") <= SAMPLE_LENGTH)
               .groupBy("kind", "value").agg(F.count("*").alias("n")))
    order = Window.partitionBy("kind").orderBy(F.xxhash64("value"), "value")
    picked = counted.withColumn("at", F.row_number().over(order)).where(F.col("at") <= sample).collect()
    return Formats(sorted((r["kind"], r["value"], r["n"]) for r in picked), ordinary_counts(rows))


def scan(docs, formats=None):
    """All spans of every text: (doc_id, spans array<struct<kind,start,end,value>>), code points, end exclusive.

    Kinds assign, access and hex are the fixed patterns; kind format is what the automata add outside of them.
    Null texts are empty, rows stay as they are (also repeated ones and null ids), other columns are ignored.
    A table without labelled credentials has no automata and nothing is added.
    """
    shared = docs.sparkSession.sparkContext.broadcast(formats or learn(docs))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                               ("value", pa.string())]))

    def run(batches):
        own = shared.value
        for batch in batches:
            out = []
            for text in batch["text"].to_pylist():
                base = base_spans(text)
                found = sorted(base + own.spans(text, base))
                out.append([{"kind": KINDS[k], "start": s, "end": e, "value": v} for s, k, e, v in found])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(out, kind)], ["doc_id", "spans"])

    return id_and_text(docs).mapInArrow(
        run, "doc_id long, spans array<struct<kind:string,start:long,end:long,value:string>>")


def span_digest(scanned):
    """The contract's columns, derived from the operator's spans."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(
            ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda x: x["kind"] != KINDS[3])
    return scanned.select("doc_id", *[count(k) for k in KINDS[:3]], F.sha2(joined(base), 256).alias("base_sha256"),
                          joined(F.col("spans")).alias("spans"), count(KINDS[3]))


def redact(docs, formats=None, mark="[SECRET]"):
    """The documents with every secret's value replaced by `mark`: same rows, ids and columns, n_chars renewed.

    Of a span the value goes (for an assignment what is assigned; the name stays). A null text stays null.
    """
    shared = docs.sparkSession.sparkContext.broadcast(formats or learn(docs))

    def clean(text):
        base = base_spans(text)
        spans = base + shared.value.spans(text, base)
        if not spans:
            return text
        cuts, out, at = sorted((end - len(value), end) for _, _, end, value in spans), [], 0
        for start, end in cuts:
            if end <= at:
                continue
            if start >= at:
                out += [text[at:start], mark]
            at = end
        return "".join(out) + text[at:]

    schema = docs.schema
    place = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts = [None if t is None else clean(t) for t in batch.column(place).to_pylist()]
            columns = list(batch.columns)
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    changed = docs.mapInArrow(run, schema)
    return changed.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else changed
