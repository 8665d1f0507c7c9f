"""Token ids as a compressed binary corpus: a context-mixing range coder.

Format. A corpus is a table of blocks, written by Spark in the order of the
documents: file number, block number, first document, the document ids and
lengths, and one payload each. A payload is independent of all others: the model
starts anew in every block, and a CRC-32 of the ids guards it.

Inside a block the ids are cut into up to ``LANES`` equal runs (lanes) that are
coded side by side: step t codes the t-th id of every lane with a range coder of
its own, and all lanes share one adaptive model, which learns from the step's ids
after the step. So a step is a few dozen vector operations, in the coder as in the
decoder. For each id the model mixes three predictions:

- order 2: the id that last followed the two ids before, with a confidence count;
- order 1: the id that last followed the id before, with a confidence count;
- order 0: the adaptive frequencies of the block's ids.

The mixing weights are chosen by both confidences and by whether orders 2 and 1
agree, and are learned from how often each was right in that state. The mixture is
coded in one step of a carry-less range coder (64-bit state, 32-bit words): the
range is parted into the share of order 2, the share of order 1, and order 0's
frequencies scaled to the rest. All arithmetic is on integers, so files read the same
anywhere.

Documents are coded in ascending order of id: they are dealt by ranges of the id,
sorted inside each range, and cut into blocks of about ``BLOCK_IDS`` ids; the
start of each document is the running count of ids in its file plus the counts of
the files before it (one row a file).

Defined results: a null or empty text is the end id alone; a null id is last in
order; rows that repeat an id follow each other, ordered by text; an empty table gives
an empty corpus; a very long text is one document in one block. Only id and text are read.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curlew.llm.common import few, releasing

LANES = 4096
LANE_IDS = 256  # fewer lanes for blocks under LANES * LANE_IDS ids
BLOCK_IDS = 1 << 20
SLOT_BITS = 18
SLOTS = 1 << SLOT_BITS  # contexts of order 2
_SLOT_SHIFT = 32 - SLOT_BITS
_SCALE = 28  # bits of the mixture's parts
_WORD = np.uint64(32)
_LEAST = np.uint64(1 << 32)  # the range is at least this before a step
_MAX_BITS = 22
_HEAD = struct.Struct("<4sIIIIB3x")  # magic, ids, crc, lanes, alphabet, bits of order 0
_MAGIC = b"CMR2"
_CONF = 15  # largest confidence
_STATES = (_CONF + 1) * (_CONF + 1) * 2


# the change of a context's entry by its confidence (0 to 15) when its guess was wrong, then right
_CHANGE = np.array([0, 0] + [-((c + 1) // 2) for c in range(2, _CONF + 1)] + [1] * _CONF + [0])


class _Model:
    """The adaptive model of one block, over symbols 0..n-1."""

    def __init__(self, n: int, lanes: int, bits: int):
        self.n, self.bits = n, bits
        self.counts = np.zeros(n, np.int64)
        self.pending: list[np.ndarray] = []
        self.seen, self.due, self.step = 0, 0, 0
        # the id that last followed a context and the confidence in it: id * 16 + confidence
        self.two = np.zeros(SLOTS, np.int64)
        self.one = np.zeros(n + 1, np.int64)
        # how often order 0, 2 and 1 were right, for each state
        self.right = np.ones((3, _STATES), np.int64)
        self.right[0] = 8
        state = np.arange(_STATES)
        self.can2, self.can1 = state // 32 > 0, (state // 2 % 16 > 0) & ((state // 32 == 0) | (state % 2 == 0))
        self.prev, self.prev2 = np.full(lanes, n), np.full(lanes, n)
        self._frequencies()
        self._weights()

    def _frequencies(self) -> None:
        if self.pending:
            self.counts += np.bincount(np.concatenate(self.pending), minlength=self.n)
            self.pending = []
        spare = (1 << self.bits) - self.n
        freq = 1 + (self.counts * spare // self.seen if self.seen else np.zeros(self.n, np.int64))
        freq[int(self.counts.argmax())] += (1 << self.bits) - int(freq.sum())
        self.freq = freq
        self.cum = np.concatenate([[0], np.cumsum(freq)]).astype(np.uint64)
        self.next = self.cum[1:]
        self.slots = None

    def _weights(self) -> None:
        """Shares of orders 2 and 1 in 2**_SCALE, for each state; order 0 has a 64th at least."""
        share = ((self.right[1:] * 64512) // self.right.sum(axis=0)).astype(np.uint64) << np.uint64(_SCALE - 16)
        self.part2 = share[0] * self.can2
        self.parts = self.part2 + share[1] * self.can1

    def predict(self, m: int):
        """For the first m lanes: the contexts' entries, the guesses of orders 2 and 1, and the ends of their shares."""
        p1 = self.prev[:m]
        slot = ((self.prev2[:m] * 40503 + p1) * 2654435769 & 0xFFFFFFFF) >> _SLOT_SHIFT
        two, one = self.two.take(slot), self.one.take(p1)
        g2, g1 = two >> 4, one >> 4
        c2, c1 = two & 15, one & 15
        state = (c2 << 5) + (c1 << 1) + (g2 == g1)
        return slot, two, one, c2, c1, g2, g1, state, self.part2.take(state), self.parts.take(state)

    def learn(self, ids: np.ndarray, seen, hit2: np.ndarray, hit1: np.ndarray) -> None:
        """``hit2``, ``hit1``: the lanes whose id was coded as the guess of order 2 or 1."""
        slot, two, one, c2, c1, g2, g1, state, _, _ = seen
        m = len(ids)
        self.right += np.bincount(state + hit2 * _STATES + hit1 * (2 * _STATES), minlength=3 * _STATES).reshape(3, -1)
        self.step += 1
        if self.step < 16 or self.step % 4 == 0:
            self.right[:, self.right[0] > 1 << 14] >>= 1
            np.maximum(self.right, 1, out=self.right)
            self._weights()
        new = (ids << 4) + 1
        # of several lanes with one context the last one counts
        self.two[slot] = self._followed(two, c2, g2 == ids, new)
        self.one[self.prev[:m]] = self._followed(one, c1, g1 == ids, new)
        if m == len(self.prev):
            self.prev2, self.prev = self.prev, ids
        else:
            self.prev2[:m] = self.prev[:m]
            self.prev = np.concatenate([ids, self.prev[m:]])
        self.pending.append(ids)
        self.seen += m
        if self.seen >= self.due:
            self._frequencies()
            self.due = self.seen + max(m, min(self.seen // 2, 32 * m))

    @staticmethod
    def _followed(old: np.ndarray, c: np.ndarray, right: np.ndarray, new: np.ndarray) -> np.ndarray:
        """Right: one more confidence. Wrong: half of it, and the new id at the lowest."""
        return np.where((c > 1) | right, old + _CHANGE.take(c + right * 16), new)

    def symbol_at(self, place: np.ndarray) -> np.ndarray:
        if self.slots is None:
            self.slots = np.repeat(np.arange(self.n), self.freq)
        return self.slots.take(place)


class _Coder:
    """One carry-less range coder for each lane."""

    def __init__(self, lanes: int):
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, np.uint64(2**64 - 1))

    def narrow(self, m: int, unit: np.ndarray, start: np.ndarray, size: np.ndarray) -> Iterator[np.ndarray]:
        """Takes the part [start, start + size) of the first m lanes' ranges; yields the lanes that shift a word out, until none does."""
        low, span = self.low[:m], self.range[:m]
        low += unit * start
        np.multiply(unit, size, out=span)
        at = np.flatnonzero((low ^ (low + (span - np.uint64(1)))) < _LEAST)
        at = at if int(span.min()) >= _LEAST else np.flatnonzero(((low ^ (low + (span - np.uint64(1)))) < _LEAST) | (span < _LEAST))
        while len(at):
            yield at
            # a narrow range that crosses a word's border ends there
            l, r = low.take(at), span.take(at)
            settled = (l ^ (l + r - np.uint64(1))) < _LEAST
            r = np.where(settled, np.minimum(r, _LEAST - np.uint64(1)), (~l + np.uint64(1)) & (_LEAST - np.uint64(1)))
            l, r = l << _WORD, r << _WORD
            low[at], span[at] = l, r
            at = at[(l ^ (l + r - np.uint64(1)) < _LEAST) | (r < _LEAST)]


def _shape(n: int) -> tuple[int, int, int]:
    """Steps, lanes, and ids of the last lane; the other lanes are full."""
    steps = -(-n // max(1, min(LANES, -(-n // LANE_IDS))))
    lanes = -(-n // steps)
    return steps, lanes, n - (lanes - 1) * steps


def _bits(alphabet: int) -> int:
    bits = max(15, int(alphabet).bit_length() + 1)
    if bits > _MAX_BITS:
        raise ValueError("a block holds more different ids than its frequencies can tell apart")
    return bits


def _alphabet(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ids in order, and each id's place among them."""
    top = int(ids.max())
    if top >= 1 << 22:
        return np.unique(ids, return_inverse=True)
    there = np.bincount(ids, minlength=top + 1) > 0
    return np.flatnonzero(there).astype(np.uint32), (np.cumsum(there) - 1).take(ids)


def _ranges(model: _Model, ids: np.ndarray, part2: np.ndarray, parts: np.ndarray, hit2: np.ndarray, hit1: np.ndarray):
    """Start and size of each id in the mixture."""
    rest, bits = np.uint64(1 << _SCALE) - parts, np.uint64(model.bits)
    start = (model.cum.take(ids) * rest >> bits) + parts
    end = (model.next.take(ids) * rest >> bits) + parts
    guess = hit2 | hit1
    start = np.where(guess, part2 * hit1, start)
    end = np.where(guess, np.where(hit2, part2, parts), end)
    return start, end - start


def encode_block(ids: np.ndarray) -> bytes:
    """The payload of a block of unsigned 32-bit ids."""
    ids = np.ascontiguousarray(ids, np.uint32)
    n = len(ids)
    if not n:
        return _HEAD.pack(_MAGIC, 0, 0, 0, 0, 0)
    alphabet, symbols = _alphabet(ids)
    steps, lanes, last = _shape(n)
    # a row for each step: the t-th id of every lane
    grid = np.ascontiguousarray(np.pad(symbols, (0, lanes * steps - n)).reshape(lanes, steps).T)
    bits = _bits(len(alphabet))
    model, coder = _Model(len(alphabet), lanes, bits), _Coder(lanes)
    words, used = np.zeros((lanes, 32 + steps // 2), np.uint32), np.zeros(lanes, np.int64)
    for t in range(steps):
        if int(used.max()) + 16 > words.shape[1]:  # an id shifts out far fewer words than this
            words = np.concatenate([words, np.zeros_like(words)], axis=1)
        m = lanes if t < last else lanes - 1
        now = grid[t, :m]
        seen = model.predict(m)
        g2, g1, part2, parts = seen[5], seen[6], seen[8], seen[9]
        hit2 = (g2 == now) & (part2 > 0)
        hit1 = (g1 == now) & (parts > part2) & ~hit2
        start, size = _ranges(model, now, part2, parts, hit2, hit1)
        for out in coder.narrow(m, coder.range[:m] >> np.uint64(_SCALE), start, size):
            words[out, used[out]] = coder.low[out] >> _WORD
            used[out] += 1
        model.learn(now, seen, hit2, hit1)
    # the last two words say a value inside the range
    tail = np.stack([coder.low >> _WORD, coder.low & (_LEAST - np.uint64(1))], axis=1).astype(np.uint32)
    words = np.concatenate([words, np.zeros((lanes, 2), np.uint32)], axis=1)
    for k in (0, 1):
        words[np.arange(lanes), used + k] = tail[:, k]
    streams = words[np.arange(words.shape[1]) < (used + 2)[:, None]]
    letters = zlib.compress(np.diff(alphabet, prepend=np.uint32(0)).astype("<u4").tobytes(), 6)
    head = _HEAD.pack(_MAGIC, n, zlib.crc32(ids.astype("<u4").tobytes()), lanes, len(alphabet), bits)
    lengths = zlib.compress((used + 2).astype("<u4").tobytes(), 6)
    return b"".join([head, struct.pack("<II", len(letters), len(lengths)), letters, lengths, streams.astype("<u4").tobytes()])


def decode_block(payload: bytes) -> np.ndarray:
    """The ids of a block; raises if the checksum differs."""
    magic, n, crc, lanes, size, bits = _HEAD.unpack_from(payload)
    if magic != _MAGIC:
        raise ValueError("not a block of token ids")
    if not n:
        return np.zeros(0, np.uint32)
    at = _HEAD.size + 8
    a, b = struct.unpack_from("<II", payload, _HEAD.size)
    alphabet = np.cumsum(np.frombuffer(zlib.decompress(payload[at:at + a]), "<u4"), dtype=np.uint32)
    used = np.frombuffer(zlib.decompress(payload[at + a:at + a + b]), "<u4").astype(np.int64)
    if len(alphabet) != size or len(used) != lanes:
        raise ValueError("a block's tables are damaged")
    words = np.concatenate([np.frombuffer(payload[at + a + b:], "<u4"), np.zeros(4, "<u4")]).astype(np.uint64)
    here = np.cumsum(used) - used
    code = words[here] << _WORD | words[here + 1]
    here += 2
    steps, again, last = _shape(n)
    if again != lanes:
        raise ValueError("a block has another number of lanes than its ids need")
    grid = np.zeros((steps, lanes), np.int64)
    model, coder = _Model(size, lanes, bits), _Coder(lanes)
    whole, shift = np.uint64(1 << _SCALE), np.uint64(bits)
    for t in range(steps):
        m = lanes if t < last else lanes - 1
        seen = model.predict(m)
        g2, g1, part2, parts = seen[5], seen[6], seen[8], seen[9]
        unit = coder.range[:m] >> np.uint64(_SCALE)
        value = np.minimum((code[:m] - coder.low[:m]) // unit, whole - np.uint64(1))
        # the frequency slot of order 0; lanes that a guess has taken look up slot 0
        by0, hit2 = value >= parts, value < part2
        hit1 = ~(by0 | hit2)
        slot = (((value - parts) * by0 + np.uint64(1) << shift) - np.uint64(1)) // (whole - parts)
        now = np.where(by0, model.symbol_at(slot.view(np.int64)), np.where(hit2, g2, g1))
        grid[t, :m] = now
        start, width = _ranges(model, now, part2, parts, hit2, hit1)
        for out in coder.narrow(m, unit, start, width):
            code[out] = code[out] << _WORD | words[here[out]]
            here[out] += 1
        model.learn(now, seen, hit2, hit1)
    ids = alphabet.take(grid.T.reshape(-1)[:n])
    if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
        raise ValueError("a block's checksum differs")
    return ids


# letters whose case and form need no table beyond Latin, and marks, each of which ends a piece of letters
_SIMPLE = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
_LETTERS = "".join(c for c in map(chr, range(0x100)) if re.match(_SIMPLE, c))
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_CACHE_LIMIT = 400_000  # parts of words of a generation, two of them a worker
_SLICE_BYTES = 4 << 20  # texts that are encoded together
_CHUNK = 50


class Encoder:
    """Encodes texts with a tokenizer file.

    ``by_word`` is for tokenizers of the kind of word_bpe_49k, which drop white
    space, level case, part letters from marks before the model sees them, and end
    each piece with ``</w>``: the ids of a text are then those of its space-separated
    words, one after the other, and the ids of letters with marks after them are those
    of the letters and of the marks. Each new part is tokenized once and kept in a
    cache of two generations, so that frequent parts stay when it is full; runs of
    letters go to the tokenizer without the steps that would not change them.
    ``by_word=False`` encodes whole texts."""

    def __init__(self, path: str, by_word: bool = True, kept_words: int = _CACHE_LIMIT):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = by_word
        self.kept_words = kept_words
        self.new: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}
        if by_word:
            self.plain = Tokenizer(self.tokenizer.model)  # the model is held once
            self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            vocabulary = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
            # the model's letters for bytes, none of which is a letter that has them
            level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self.letters = {chr(c): level.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100)}

    def forget(self) -> None:
        """Empties the cache."""
        self.new, self.old = {"": b""}, {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(g.ids, "<u4").tobytes() for g in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _letters(self, runs: list[str]) -> list[bytes]:
        """Ids of runs of small letters, each of which is one piece for the model."""
        text = " ".join(runs)
        if not text.isascii():
            for letter, model in self.letters.items():
                text = text.replace(letter, model)
        written = text.split(" ")
        chunks = [" ".join(written[a:a + _CHUNK]) for a in range(0, len(runs), _CHUNK)]
        ids = np.concatenate([np.array(g.ids, "<u4") for g in self.plain.encode_batch_fast(chunks, add_special_tokens=False)])
        ends = (np.flatnonzero(self.ends[ids]) + 1) * 4
        if len(ends) != len(runs):
            return self._whole(runs)
        body = ids.tobytes()
        return [body[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def _kept(self, parts: pa.Array) -> list[bytes]:
        """Ids of parts of words, which are in the cache afterwards."""
        names = _strings(parts)
        ids = list(map(self.new.get, names))
        gaps = [i for i, x in enumerate(ids) if x is None]
        if gaps:
            simple = pc.match_substring_regex(parts.take(pa.array(gaps)), _SIMPLE).to_numpy(zero_copy_only=False).tolist()
            runs, other = [], []
            for i, letters in zip(gaps, simple, strict=True):
                ids[i] = self.old.get(names[i])
                if ids[i] is None:
                    (runs if letters else other).append(i)
            for at, of in ((runs, self._letters), (other, self._whole)):
                if at:
                    for i, got in zip(at, of([names[i] for i in at]), strict=True):
                        ids[i] = got
            self.new.update(zip(map(names.__getitem__, gaps), map(ids.__getitem__, gaps), strict=True))
        return ids

    def _words(self, words: pa.Array) -> pa.Array:
        """Ids of words: those of their letters, in lower case, and of the marks after them; other words are one part."""
        core = pc.utf8_rtrim(words, _MARKS)
        simple = pc.match_substring_regex(core, _SIMPLE)
        core = pc.if_else(simple, pc.utf8_lower(core), words).dictionary_encode()
        marks = pc.if_else(simple, pc.utf8_ltrim(words, _LETTERS), "").dictionary_encode()
        ids = pa.array(self._kept(pa.concat_arrays([core.dictionary, marks.dictionary])), pa.large_binary())
        return pc.binary_join_element_wise(ids.take(core.indices), ids.slice(len(core.dictionary)).take(marks.indices), pa.scalar(b"", pa.large_binary()))

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and the number of each text's."""
        end = b"" if end_id is None else struct.pack("<I", end_id)
        texts = pc.fill_null(texts, "")
        if not self.by_word:
            got = [g + end for g in self._whole(texts.to_pylist())]
            return np.frombuffer(b"".join(got), "<u4"), np.array([len(g) // 4 for g in got], np.int64)
        if len(self.new) > self.kept_words:
            self.old, self.new = self.new, {"": b""}
        # where lower case is a matter of single letters and no special token stands, it joins words of a sentence's start with the others
        simple = pc.invert(pc.match_substring_regex(texts, "[^\\x{0}-\\x{ff}]|<\\|"))
        texts = pc.if_else(simple, pc.utf8_lower(texts), texts)
        words = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        per_text = np.diff(words.offsets.to_numpy())
        coded = words.flatten().dictionary_encode()
        ids = pa.concat_arrays([self._words(coded.dictionary), pa.array([end], pa.large_binary())])
        # each text is its words and the end id
        index = np.insert(coded.indices.to_numpy(), np.cumsum(per_text), len(ids) - 1)
        flat = ids.take(pa.array(index))
        _, offsets, body = flat.buffers()
        upto = np.frombuffer(offsets, np.int64, len(flat) + 1) // 4
        totals = np.diff(upto.take(np.cumsum(per_text + 1)), prepend=0)
        return np.frombuffer(body, "<u4", int(upto[-1])), totals


def _strings(words: pa.Array) -> list[str]:
    """The words, none of which holds a space."""
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), " ")
    return joined[0].as_py().split(" ") if len(words) else []


_encoders: dict[tuple[str, bool, int], Encoder] = {}


def _encoder(path: str, by_word: bool, kept_words: int = _CACHE_LIMIT) -> Encoder:
    """One for each worker process."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if (path, by_word, kept_words) not in _encoders:
        _encoders[path, by_word, kept_words] = Encoder(path, by_word, kept_words)
    return _encoders[path, by_word, kept_words]


_BLOCK = pa.schema([("file", pa.int32()), ("block", pa.int32()), ("ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())), ("payload", pa.binary())])
BLOCKS = "file int, block int, ids long, doc_ids array<long>, lengths array<int>, payload binary"


def _block_writer(path: str, end_id: int | None, by_word: bool, block_ids: int, kept_words: int, slice_bytes: int, keep_cache: bool):
    @releasing
    def run(batches):
        from pyspark import TaskContext

        file, number = TaskContext.get().partitionId(), 0
        encoder = _encoder(path, by_word, kept_words)
        keys: list = []
        held: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        size = 0

        def block():
            lengths = np.concatenate(counts)
            row = [file, number, size, keys, lengths.tolist(), encode_block(np.concatenate(held))]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _BLOCK, strict=True)], schema=_BLOCK)

        for batch in batches:
            for part in few(batch, 1, slice_bytes):
                names = part.column(0).to_pylist()
                ids, totals = encoder.encode(part.column(1), end_id)
                ends = np.cumsum(totals)
                first = 0
                while first < len(names):
                    # as many texts as the block has room for, but one at least
                    done = int(ends[first - 1]) if first else 0
                    last = int(np.searchsorted(ends, done + block_ids - size, side="right"))
                    if last <= first:
                        if size:
                            yield block()
                            keys, held, counts, size, number = [], [], [], 0, number + 1
                            continue
                        last = first + 1
                    keys += names[first:last]
                    held.append(ids[done:int(ends[last - 1])])
                    counts.append(totals[first:last])
                    size += int(ends[last - 1]) - done
                    first = last
        if keys:
            yield block()
        if not keep_cache:
            encoder.forget()
            _encoders.pop((path, by_word, kept_words), None)
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 2, id_col: str = "doc_id", text_col: str = "text",
                 by_word: bool = True, files: int | None = None, block_ids: int = BLOCK_IDS, kept_words: int = _CACHE_LIMIT, slice_bytes: int = _SLICE_BYTES, keep_cache: bool = True) -> None:
    """Write the ids of all documents, in ascending order of id, as a corpus of blocks.
    ``kept_words`` (of a generation of the word cache) and ``slice_bytes`` (texts that are
    encoded together) trade a worker's memory for time; without ``keep_cache`` a worker
    holds no words between its tasks. The corpus is the same."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    files = files or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the borders of the files come from the ids alone, so the texts are read once
    borders = rows.agg(F.percentile_approx("doc_id", [k / files for k in range(1, files)], 100_000)).first()[0] if files > 1 else None
    file = F.lit(0)
    if borders:
        file = F.coalesce(F.size(F.filter(F.array(*[F.lit(b) for b in sorted(set(borders))]), lambda b: b < F.col("doc_id"))), F.lit(0))
        file = F.when(F.col("doc_id").isNull(), files - 1).otherwise(file)
    dealt = rows.repartitionById(files, file.cast("int")).sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "text")
    dealt.mapInArrow(_block_writer(tokenizer, end_id, by_word, block_ids, kept_words, slice_bytes, keep_cache), BLOCKS).write.option("compression", "none").parquet(path)


def _block_starts(blocks: DataFrame) -> DataFrame:
    """file, block, base: the ids of the whole corpus before each block. Counts run
    inside a file, then over the files (one row each)."""
    small = blocks.select("file", "block", "ids")
    inside = F.sum("ids").over(Window.partitionBy("file").orderBy("block")) - F.col("ids")
    per = small.groupBy("file").agg(F.sum("ids").alias("n"))
    before = per.select(F.col("file").alias("f"), (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("before"))
    return small.select("file", "block", inside.alias("inside")).join(before, F.col("file") == F.col("f")).select(
        F.col("file").alias("f"), F.col("block").alias("b"), (F.col("inside") + F.col("before")).alias("base"))


def _reader(with_ids: bool):
    @releasing
    def run(batches):
        for batch in batches:
            for file, number, keys, lengths, payload in zip(*(batch.column(c) for c in ("file", "block", "doc_ids", "lengths", "payload")), strict=True):
                ids = decode_block(payload.as_buffer().to_pybytes()).astype("<u4")
                lengths = np.array(lengths.as_py(), np.int64)
                ends = np.cumsum(lengths)
                if len(ids) != (ends[-1] if len(ends) else 0):
                    raise ValueError("a block's documents and ids differ in number")
                parts = np.split(ids, ends[:-1])
                cols = [pa.array([file.as_py()] * len(parts), pa.int32()), pa.array([number.as_py()] * len(parts), pa.int32()), keys.values,
                        pa.array(ends - lengths), pa.array(lengths), pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64())]
                names = ["file", "block", "doc_id", "inside", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids.astype(np.int64))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)
    return run


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and, with ``with_ids``, ids: a row for each
    document, decoded from the blocks, whose checksums are verified."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    out = "file int, block int, doc_id long, inside long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    rows = blocks.select("file", "block", "doc_ids", "lengths", "payload").mapInArrow(_reader(with_ids), out)
    rows = rows.join(_block_starts(blocks), (F.col("file") == F.col("f")) & (F.col("block") == F.col("b")))
    return rows.select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)
