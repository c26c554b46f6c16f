"""Pieces of a SentencePiece vocabulary: encoding, and decoding.

Both kinds of model are encoded by one streaming search over boundaries with back pointers. In a unigram model the best sum
of scores (log probabilities) decides which piece ends at a boundary, in a BPE model which piece merging leaves there.
"""

import zlib

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece

from shoplens.llm.common import id_and_text

SPACE = "▁"
FED = 4096  # characters given to the search at a time
UNKNOWN_PENALTY = 10.0  # an unknown character scores this much below the worst piece


class StreamingViterbi:
    """Best-scoring segmentation of a stream of characters in a window as long as the longest piece.

    For each character boundary in the window it keeps the best score and a back pointer. Boundaries older than
    the longest piece can only be reached through the survivors: as soon as the back pointers of all of them run
    through one boundary, the ids before it can never change and are committed, and the scores start anew from
    there. Ties go to the longer last piece. `feed` takes any stretch of text, `close` ends the stream.
    """

    def __init__(self, scores, ids, longest, unknown_score):
        self.scores, self.ids, self.longest, self.unknown = scores, ids, longest, unknown_score
        self.endings = {p[i:] for p in scores for i in range(len(p))}
        self.buffer, self.best, self.back, self.out = "", [0.0], [0], []

    def _extend(self, end):
        scores, best = self.scores, self.best
        top, where = -1e300, end - 1
        for start in range(end - 1, max(0, end - self.longest) - 1, -1):
            part = self.buffer[start:end]
            score = scores.get(part, self.unknown if start == end - 1 else None)
            if score is not None and score + best[start] >= top:
                top, where = score + best[start], start
            if part not in self.endings:
                break  # no piece ends with this or with anything longer
        best.append(top)
        self.back.append(where)

    def _commit(self, boundary):
        """Writes the ids of the best path to `boundary` and drops all before it."""
        path, at = [], boundary
        while at:
            path.append((self.back[at], at))
            at = self.back[at]
        for start, end in reversed(path):
            self.out.extend(self.ids(self.buffer[start:end]))
        base = self.best[boundary]
        self.buffer = self.buffer[boundary:]
        self.best = [b - base for b in self.best[boundary:]]
        self.back = [max(0, b - boundary) for b in self.back[boundary:]]

    def _converged(self):
        """The last boundary that every path to a boundary still in reach runs through."""
        end = len(self.back) - 1
        points = set(range(max(0, end - self.longest + 1), end + 1))
        while len(points) > 1:
            latest = max(points)
            points.discard(latest)
            points.add(self.back[latest])
        return points.pop()

    def feed(self, text):
        at = len(self.best) - 1
        self.buffer += text
        for end in range(at + 1, len(self.buffer) + 1):
            # positions shift when ids are committed
            self._extend(len(self.best))
            if len(self.best) > 2 * self.longest:
                boundary = self._converged()
                if boundary:
                    self._commit(boundary)

    def close(self):
        self._commit(len(self.best) - 1)
        out, self.buffer, self.best, self.back, self.out = self.out, "", [0.0], [0], []
        return out


class PieceCodec:
    """Encodes and decodes whole texts.

    No piece has a space mark after another character, so all paths converge before each run of marks. Between
    two such points the stream starts from nothing, so the ids of a stretch are kept and looked up the next time
    it comes; the memory is emptied when full. A character outside the vocabulary becomes its UTF-8 byte pieces.
    """

    def __init__(self, path, memory=900_000):
        model = self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(count)]
        plain = [i for i in range(count) if not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i)
                                                 or model.is_byte(i))]
        scores = {names[i]: model.get_score(i) for i in plain}
        self.number = {names[i]: i for i in plain}
        self.bytes = {int(names[i][3:5], 16): i for i in range(count) if model.is_byte(i)}
        self.unknown_id = model.unk_id()
        if any(SPACE in p.lstrip(SPACE) for p in scores):
            raise ValueError("pieces with a space mark inside need stretches of another kind")
        self.viterbi = StreamingViterbi(scores, self._ids, max(map(len, scores)),
                                        min(scores.values()) - UNKNOWN_PENALTY)
        self.memory, self.known = memory, {}

    def _ids(self, piece):
        found = self.number.get(piece)
        if found is not None:
            return (found,)
        raw = piece.encode()
        return [self.bytes[b] for b in raw] if self.bytes else (self.unknown_id,)

    def _stretch(self, word):
        for start in range(0, len(word), FED):
            self.viterbi.feed(word[start:start + FED])
        return np.array(self.viterbi.close(), "<u4").tobytes()

    def encode(self, text):
        """ids as a little-endian 32-bit array."""
        if not text:
            return np.empty(0, "<u4")
        first, *words = self.model.normalize(text).split(SPACE)
        stretches, run = [], ""
        for word in words:  # a stretch is a run of marks and what follows it
            run += SPACE
            if word:
                stretches.append(run + word)
                run = ""
        if run:
            stretches.append(run)
        if first:
            stretches.insert(0, first)
        known = self.known
        for word in set(stretches).difference(known):
            if len(known) >= self.memory:
                known.clear()
            known[word] = self._stretch(word)
        missing = [w for w in set(stretches) if w not in known]  # the memory was emptied half-way
        known.update((w, self._stretch(w)) for w in missing)
        return np.frombuffer(b"".join(map(known.__getitem__, stretches)), "<u4")

    def decode(self, ids):
        return self.model.decode(ids.tolist())


class StreamingPairs(StreamingViterbi):
    """The same search where scores are ranks of merges, whose sum means nothing: a path counts if merging gives it.

    Merging joins, of all neighbours whose join is a piece, the best-scoring, leftmost ones. A row of pieces is its result
    if and only if each two neighbours are: merging what they spell gives these two. So a piece may end at a boundary if it
    goes with the last piece of the path to where it starts; one does at each boundary, and that is its back pointer.
    The window, the surviving paths and the rule when ids are committed are those of the search above; the last
    committed piece is kept, since the next one has to go with it.
    """

    MEMORY = 2_000_000

    def __init__(self, scores, ids, longest):
        super().__init__(scores, ids, longest, None)
        self.pairs, self.held = {}, 0
        self.automaton = ahocorasick.Automaton()
        for piece in scores:
            self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        self._restart()

    def _restart(self):
        self.buffer, self.back, self.last, self.out = "", [0], [""], []
        self.dropped = 0

    def merged(self, text):
        """The pieces that merging a short text gives."""
        parts, score = list(text), self.scores.get
        values = [score(text[i:i + 2], -1e300) for i in range(len(text) - 1)]
        while values:
            best = max(values)
            if best == -1e300:
                break
            i = values.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del values[i]
            if i:
                values[i - 1] = score(parts[i - 1] + parts[i], -1e300)
            if i < len(values):
                values[i] = score(parts[i] + parts[i + 1], -1e300)
        return parts

    def _together(self, before, piece):
        own = self.pairs.get(before)
        if own is None:
            own = self.pairs[before] = {}
        found = own.get(piece)
        if found is None:
            if self.held >= self.MEMORY:
                self.pairs, self.held, own = {}, 0, {}
                self.pairs[before] = own
            found = own[piece] = self.merged(before + piece) == ([before, piece] if before else [piece])
            self.held += 1
        return found

    def _ends_here(self, piece):
        self.back.append(len(self.back) - len(piece))
        self.last.append(piece)

    def _commit(self, boundary):
        path, at = [], boundary
        while at:
            path.append(self.last[at])
            at = self.back[at]
        for piece in reversed(path):
            self.out.extend(self.ids(piece))
        self.buffer, self.last = self.buffer[boundary:], self.last[boundary:]
        self.back = [max(0, b - boundary) for b in self.back[boundary:]]
        self.dropped += boundary

    def feed(self, text):
        """One automaton over all pieces reads on, and names at each character the pieces that end there, longest first."""
        self.buffer += text
        back, last, together = self.back, self.last, self._together
        # pieces that end in the new text start at most the longest piece's length before it
        first, dropped = max(0, len(back) - self.longest), self.dropped
        for index, piece in self.automaton.iter(self.buffer[first:]):
            end, size = first + index + 1 + dropped - self.dropped, len(piece)
            if end < len(back) or end < size:
                continue  # that boundary has its piece, or this one starts before what is committed
            while len(back) < end:
                self._ends_here(self.buffer[len(back) - 1])  # a character that no piece ends with
            if size == 1 or together(last[end - size], piece):
                back.append(end - size)
                last.append(piece)
                if end > 2 * self.longest:
                    boundary = self._converged()
                    if boundary:
                        self._commit(boundary)
                        back, last = self.back, self.last
        while len(self.back) <= len(self.buffer):
            self._ends_here(self.buffer[len(self.back) - 1])

    def close(self):
        self._commit(len(self.back) - 1)
        out = self.out
        self._restart()
        return out


class MergeCodec(PieceCodec):
    """Encodes with a BPE model as the model's own encoder does."""

    def __init__(self, path, memory=900_000):
        super().__init__(path, memory)
        self.viterbi = StreamingPairs(self.viterbi.scores, self._ids, self.viterbi.longest)


def codec_of(path):
    """The codec for the kind of model that its trainer's settings name."""
    return MergeCodec(path) if model_type(path) == BPE else PieceCodec(path)


UNIGRAM, BPE = 1, 2  # fixed values: the model types of the model file's trainer settings


def model_type(path):
    """The type in a model file: field 3 of its trainer settings, which are field 2 (protocol buffer wire format)."""
    def fields(raw):
        at = 0

        def number():
            nonlocal at
            value = shift = 0
            while True:
                byte = raw[at]
                at += 1
                value |= (byte & 127) << shift
                shift += 7
                if byte < 128:
                    return value

        while at < len(raw):
            tag = number()
            if tag & 7 == 0:
                yield tag >> 3, number()
            elif tag & 7 == 2:
                size = number()
                yield tag >> 3, raw[at:at + size]
                at += size
            else:
                at += 8 if tag & 7 == 1 else 4

    with open(path, "rb") as source:
        settings = b"".join(value for name, value in fields(source.read()) if name == 2)
    return next((value for name, value in fields(settings) if name == 3), UNIGRAM)


_MADE = {}  # one codec for each model in a Python worker, kept from task to task


def codec_factory(path):
    def get():
        if path not in _MADE:
            _MADE[path] = codec_of(path)
        return _MADE[path]
    return get


def encode_texts(docs, model, with_ids=True):
    """Each text's ids, as the model's own encoder gives them, decoded again: (doc_id, n_tokens, ids_crc32, decoded_equal[, ids]).

    A null or empty text has no ids. Repeated rows stay, other columns are ignored, a null id stays null.
    `decoded_equal` tells whether decoding gives back the text as the vocabulary normalises it.
    """
    codec = codec_factory(model)
    names = ["doc_id", "n_tokens", "ids_crc32", "decoded_equal"] + ["ids"] * with_ids
    kinds = pa.schema(list(zip(names, [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()])))

    def run(batches):
        own = codec()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                ids = own.encode(text)
                raw = ids.tobytes()
                rows.append((doc_id, len(ids), zlib.crc32(raw), own.decode(ids) == text, raw)[:len(names)])
            columns = list(zip(*rows)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds)], schema=kinds)

    return id_and_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, decoded_equal boolean"
                                        + (", ids binary" if with_ids else ""))


def decode_ids(rows, model):
    """(doc_id, ids) -> (doc_id, text)."""
    codec = codec_factory(model)

    def run(batches):
        own = codec()
        for batch in batches:
            texts = [own.decode(np.frombuffer(x or b"", "<u4")) for x in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
