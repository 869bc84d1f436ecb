"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

The pieces come from a public model file, whose path is a parameter; nothing is trained. If the file's scores are merge ranks
(a BPE model) they are turned into log probabilities by Zipf's law; a unigram model's own scores are used as they are. The trie
is two integer arrays. A text gets a marker in front and for each space; characters without a piece fall back to byte
pieces. Pieces may be runs of markers, so a run stays with the word after it: texts are cut before a marker that follows
another character and at line ends, and at neither if a piece of the model spans such a place. The best path of a text is
that of its segments; distinct segments are solved together, column by column, in vectorised steps, and kept for later texts of the worker.

Defined results: null and empty texts have no ids; decoding gives every
text back exactly, but for a literal marker character, which decodes as a space, and lone surrogates; repeated rows repeat; a null doc_id is a row like others; columns beyond doc_id and text are neither read nor
in the way; an empty table gives an empty result; texts of any length are encoded whole.
"""

from __future__ import annotations

import hashlib
import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import body, read_documents

MARK = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_PENALTY = 10.0
SPANS = re.compile(f"[^{MARK}]{MARK}")
SEGMENTS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
KEEP = 150_000  # segments a worker remembers


def _fields(data: bytes):
    """(number, value) of a serialised message's fields."""
    at = 0

    def varint(at):
        n = shift = 0
        while True:
            b = data[at]
            n |= (b & 127) << shift
            at, shift = at + 1, shift + 7
            if b < 128:
                return n, at

    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 5:
            value, at = data[at : at + 4], at + 4
        elif kind == 1:
            value, at = data[at : at + 8], at + 8
        else:
            n, at = varint(at)
            value, at = data[at : at + n], at + n
        yield tag >> 3, value


def read_model(data: bytes) -> tuple[list[str], list[float], list[int], bool]:
    """Pieces, scores, kinds, and whether the scores are log probabilities."""
    pieces, scores, kinds, unigram = [], [], [], True
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            pieces.append(piece.get(1, b"").decode())
            scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            kinds.append(piece.get(3, NORMAL))
        elif number == 2:
            unigram = dict(_fields(value)).get(3, 1) == 1
    return pieces, scores, kinds, unigram


def double_array(keys: list[bytes], values: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base, check and value arrays: child c of node s is base[s] + c + 1 if its check is s."""
    order = sorted(range(len(keys)), key=keys.__getitem__)
    words = [keys[i] for i in order]
    size = 4 * sum(map(len, words)) + 1024
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    check[0] = -2
    span = np.arange(2048)
    low = 0  # where the search for room starts; slots before it are nearly all taken
    todo = [(0, 0, len(words), 0)]
    for node, lo, hi, depth in todo:
        if lo < hi and len(words[lo]) == depth:
            value[node] = values[order[lo]]
            lo += 1
        children, i = [], lo
        while i < hi:
            byte, j = words[i][depth], i + 1
            while j < hi and words[j][depth] == byte:
                j += 1
            children.append((byte, i, j))
            i = j
        if not children:
            continue
        at = low
        while True:
            free = np.ones(len(span), bool)
            for byte, _, _ in children:
                free &= check[at + byte + 1 : at + byte + 1 + len(span)] == -1
            found = int(free.argmax())
            if free[found]:
                break
            at += len(span)
        at += found
        base[node] = at
        for byte, i, j in children:
            check[at + byte + 1] = node
            todo.append((at + byte + 1, i, j, depth + 1))
        while (check[low + 1 : low + 257] != -1).mean() > 0.9:
            low += 64
    stop = int(base.max()) + 258
    return base[:stop], check[:stop], value[:stop]


class Codec:
    """What encoding and decoding need; built on the driver, sent to the executors (its size is that of the vocabulary)."""

    def __init__(self, data: bytes):
        pieces, scores, kinds, unigram = read_model(data)
        use = [k in (NORMAL, USER) and p != "" for p, k in zip(pieces, kinds)]
        self.by_line = not any(u and "\n" in p for p, u in zip(pieces, use))
        self.by_word = not any(u and SPANS.search(p) for p, u in zip(pieces, use))
        if not unigram:
            ranks = {i: r for r, i in enumerate(sorted((i for i, u in enumerate(use) if u), key=lambda i: -scores[i]))}
            total = float(np.log(np.sum(1.0 / np.arange(1, len(ranks) + 1))))
            scores = [-float(np.log(ranks[i] + 1.0)) - total if i in ranks else 0.0 for i in range(len(pieces))]
        self.scores = np.array(scores, np.float32)
        self.unknown = np.float32(min(s for s, u in zip(scores, use) if u) - UNKNOWN_PENALTY)
        self.base, self.check, self.value = double_array([p.encode() for p, u in zip(pieces, use) if u], [i for i, u in enumerate(use) if u])
        self.byte_ids = np.zeros(256, np.int32)
        self.raw = []
        for i, (p, k) in enumerate(zip(pieces, kinds)):
            if k == BYTE:
                self.byte_ids[int(p[3:5], 16)] = i
                self.raw.append(bytes([int(p[3:5], 16)]))
            else:
                self.raw.append(b"" if k == CONTROL else p.replace(MARK, " ").encode())
        self.is_byte = np.array([k == BYTE for k in kinds])

    def segments(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of the best path of each segment (UTF-8, not empty)."""
        out: list = [None] * len(texts)
        order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
        at = 0
        while at < len(order):  # segments of like length together, so that the matrix is dense
            stop = at
            longest = len(texts[order[at]]) * 3 // 2 + 8
            while stop < len(order) and len(texts[order[stop]]) <= longest and (stop - at) * longest < 4_000_000:
                stop += 1
            for i, ids in zip(order[at:stop], self._solve([texts[i] for i in order[at:stop]])):
                out[i] = ids
            at = stop
        return out

    def _solve(self, texts: list[bytes]) -> list[np.ndarray]:
        size = np.array([len(t) for t in texts])
        n, width = len(texts), int(size.max())
        chars = np.frombuffer(b"".join(t.ljust(width, b"\0") for t in texts), np.uint8).reshape(n, width)
        step = np.ones(256, np.int64)
        step[0xC0:0xE0], step[0xE0:0xF0], step[0xF0:] = 2, 3, 4
        starts = (chars & 0xC0) != 0x80
        best = np.full((n, width + 1), -np.inf, np.float32)
        best[:, 0] = 0
        came = np.zeros((n, width + 1), np.int32)
        piece = np.full((n, width + 1), -1, np.int32)
        for s in range(width):
            rows = np.flatnonzero((size > s) & starts[:, s])
            if not len(rows):
                continue
            here = rows
            reach = s + step[chars[here, s]]
            alone = np.zeros(n, bool)
            state, pos = np.zeros(len(rows), np.int32), s
            while len(rows):
                following = self.base[state] + chars[rows, pos] + 1
                ok = self.check[following] == state
                rows, state, pos = rows[ok], following[ok], pos + 1
                ids = self.value[state]
                has = ids >= 0
                at, ids = rows[has], ids[has]
                score = best[at, s] + self.scores[ids]
                better = score > best[at, pos]
                at_b = at[better]
                best[at_b, pos], came[at_b, pos], piece[at_b, pos] = score[better], s, ids[better]
                single = s + step[chars[at, s]] == pos
                alone[at[single]] = True
                more = size[rows] > pos
                rows, state = rows[more], state[more]
            left = ~alone[here]
            rows, ends = here[left], np.minimum(reach[left], size[here[left]])
            score = best[rows, s] + self.unknown
            better = score > best[rows, ends]
            rows, ends = rows[better], ends[better]
            best[rows, ends], came[rows, ends], piece[rows, ends] = score[better], s, -1
        parts, rows, pos = [], np.arange(n), size.astype(np.int64)
        while len(rows):
            start = came[rows, pos].astype(np.int64)
            parts.append((rows, start, pos, piece[rows, pos]))
            more = start > 0
            rows, pos = rows[more], start[more]
        rows, start, end, ids = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((start, rows))
        rows, start, end, ids = rows[order], start[order], end[order], ids[order]
        many = np.where(ids < 0, end - start, 1)
        flat = np.repeat(ids, many)
        spot = np.repeat(start - np.cumsum(many) + many, many) + np.arange(len(flat))
        owner = np.repeat(rows, many)
        unknown = flat < 0
        flat[unknown] = self.byte_ids[chars[owner[unknown], spot[unknown]]]
        return np.split(flat, np.searchsorted(owner, np.arange(1, n)))

    def encode(self, texts: list[str], memory: dict[str, bytes]) -> list[np.ndarray]:
        """The ids of each text; memory maps segments to their ids and is filled here."""
        if len(memory) > KEEP:
            memory.clear()
        end = self.byte_ids[10:11].tobytes()
        cut = []
        for text in texts:
            lines = (MARK + text.replace(" ", MARK)).split("\n") if self.by_line else [MARK + text.replace(" ", MARK)]
            cut.append([SEGMENTS.findall(line) if self.by_word else [line] for line in lines] if text else [])
        new = list({w for lines in cut for line in lines for w in line} - memory.keys())
        some = [w for w in new if w]
        memory.update((w, b"") for w in new if not w)
        memory.update((w, ids.tobytes()) for w, ids in zip(some, self.segments([w.encode("utf-8", "replace") for w in some])))
        return [np.frombuffer(end.join(b"".join([memory[w] for w in line]) for line in lines), np.int32) for lines in cut]

    def decode(self, ids: np.ndarray) -> str:
        raw = self.raw
        return b"".join([raw[i] for i in ids.tolist()]).removeprefix(b" ").decode("utf-8", "replace")


def load(path: str = MODEL) -> Codec:
    with open(path, "rb") as f:
        return Codec(f.read())


def _groups(column: list[str], limit: int = 1 << 20):
    group, size = [], 0
    for text in column:
        group.append(text)
        size += len(text)
        if size >= limit:
            yield group
            group, size = [], 0
    if group:
        yield group


def encode_documents(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """(doc_id, text, ids array<int>)."""
    shared = docs.sparkSession.sparkContext.broadcast(load(path))

    def run(batches):
        memory: dict[str, bytes] = {}
        for batch in batches:
            doc, at = batch.column("doc_id"), 0
            for texts in _groups(batch.column("text").to_pylist()):
                ids = shared.value.encode(texts, memory)
                ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32)))
                yield pa.RecordBatch.from_arrays([doc.slice(at, len(texts)), pa.array(texts, pa.string()), lists], names=["doc_id", "text", "ids"])
                at += len(texts)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body().alias("text"))
    return rows.mapInArrow(run, "doc_id long, text string, ids array<int>")


def decode_documents(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """Adds decoded and n_byte_ids to (doc_id, text, ids)."""
    shared = encoded.sparkSession.sparkContext.broadcast(load(path))

    def run(batches):
        for batch in batches:
            ids = batch.column("ids")
            flat, ends = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
            codec = shared.value
            texts = [codec.decode(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            digests = [hashlib.sha256(flat[a:b].astype("<i4").tobytes()).hexdigest() for a, b in zip(ends[:-1], ends[1:])]
            n_bytes = [int(codec.is_byte[flat[a:b]].sum()) for a, b in zip(ends[:-1], ends[1:])]
            n = pa.array(np.diff(ends).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), n, pa.array(n_bytes, pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.string())],
                names=["doc_id", "text", "n_ids", "n_byte_ids", "ids_sha256", "decoded"],
            )

    return encoded.mapInArrow(run, "doc_id long, text string, n_ids long, n_byte_ids long, ids_sha256 string, decoded string")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded and decoded: number of ids, of byte ids, hashes of ids and decoded text, exact round trip."""
    out = decode_documents(encode_documents(read_documents(spark, sf_dir)))
    return out.select("doc_id", "n_ids", "n_byte_ids", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"), (F.col("decoded") == F.col("text")).alias("round_trip"))
