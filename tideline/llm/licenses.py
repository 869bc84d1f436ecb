"""Licence scan by a positional rare-token index.

The words of all licence phrases and templates (notices, headers and whole licence texts, license_texts.py) form a fixed
vocabulary, and an index holds for each of them its postings: templates and positions in them. A first pass counts in how many
documents each word occurs (IDF over the whole corpus). Then, for each document,

- templates of whose IDF the document's words don't hold COVERAGE leave;
- of each that is left, the document's rarest words (highest IDF) are looked up until they hold LOOKED_UP of its IDF. Each place
  of such a word and each posting give a relative position; the postings are intersected by it: only those go on where so many
  of the looked-up words meet that, with everything else in place, COVERAGE could be reached. So none that reaches it is lost;
- those are scored by the IDF share of the template's words that stand in their places, and must hold the template's mandatory
  key phrase, whole and within the document.

Base phrases are anchored on their rarest word and verified word by word, so all their places are found.

Defined results: null and empty texts have no words, no labels and score 0; rows are independent of each other, so
repeated rows give repeated results; a null doc_id is a row like others; columns beyond doc_id and text are neither read nor in
the way; an empty table gives an empty result; texts of any length are scanned whole.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BYTE_CODES, blocks_of, body, prefixes, read_documents, spans_hash, text_buffers
from .license_texts import BASE, TEMPLATES

COVERAGE = 0.8  # least IDF share of a template's words
LOOKED_UP = 0.5  # IDF share of the words by which a template is looked up


def _words(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


WORDS = tuple(dict.fromkeys(w for text in [p for p, _ in BASE] + [t for _, t, _ in TEMPLATES] for w in _words(text)))
ID_OF = {w: i for i, w in enumerate(WORDS)}

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = True
_WORD[128:] = True


def _word_hashes() -> tuple[np.ndarray, np.ndarray]:
    out = []
    for w in WORDS:
        raw = np.frombuffer(w.encode(), np.uint8)
        out.append(spans_hash(prefixes(BYTE_CODES[raw]), np.array([0]), np.array([len(raw)]))[0])
    order = np.argsort(np.array(out, np.uint64))
    return np.array(out, np.uint64)[order], order.astype(np.int32)


_KNOWN, _KNOWN_IDS = _word_hashes()


def tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For texts laid end to end: each word's licence-word id or -1, and each text's first word."""
    low = _LOWER[raw]
    mask = _WORD[low]
    if not len(mask):
        return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
    first = np.zeros(len(mask) + 1, bool)
    first[offsets[:-1]] = True  # a text's first byte starts a new word
    start = mask & first[:-1]
    start[1:] |= mask[1:] & ~mask[:-1]
    start[0] = mask[0]
    stop = mask & first[1:]
    stop[:-1] |= mask[:-1] & ~mask[1:]
    stop[-1] = mask[-1]
    begins, ends = np.flatnonzero(start), np.flatnonzero(stop) + 1
    hashes = spans_hash(prefixes(BYTE_CODES[low]), begins, ends)
    at = np.minimum(np.searchsorted(_KNOWN, hashes), len(_KNOWN) - 1)
    ids = np.where(_KNOWN[at] == hashes, _KNOWN_IDS[at], -1).astype(np.int32)
    return ids, np.searchsorted(begins, offsets)


def _pieces(batch):
    raw, offsets = text_buffers(batch.column("text"))
    for i, j in blocks_of(offsets, 1 << 21):
        part = offsets[i : j + 1] - offsets[i]
        yield i, j, *tokens(raw[offsets[i] : offsets[j]], part)


def _count_documents(batches):
    for batch in batches:
        seen = np.zeros(len(WORDS), np.int64)
        for i, j, ids, first in _pieces(batch):
            where = np.flatnonzero(ids >= 0)
            doc = np.searchsorted(first, where, "right") - 1
            pairs = np.unique(doc * len(WORDS) + ids[where])
            seen += np.bincount(pairs % len(WORDS), minlength=len(WORDS))
        yield pa.RecordBatch.from_pydict({"word": pa.array(np.arange(len(WORDS), dtype=np.int32)), "docs": pa.array(seen), "rows": pa.array(np.full(len(WORDS), batch.num_rows))})


def inverse_frequencies(docs: DataFrame) -> list[float]:
    """IDF of each licence word over all documents; as many numbers as WORDS has, whatever the corpus."""
    counted = docs.select(body().alias("text")).mapInArrow(_count_documents, "word int, docs long, rows long")
    rows = {r[0]: (r[1], r[2]) for r in counted.groupBy("word").agg(F.sum("docs"), F.sum("rows")).collect()}
    return [math.log((1 + rows.get(i, (0, 0))[1]) / (1 + rows.get(i, (0, 0))[0])) + 1e-6 for i in range(len(WORDS))]


def _places(ids: np.ndarray, doc_of, phrase: list[int], anchor: int) -> np.ndarray:
    """Word positions where the phrase stands inside one document."""
    at = np.flatnonzero(ids == phrase[anchor]) - anchor
    at = at[(at >= 0) & (at + len(phrase) <= len(ids))]
    for k, w in enumerate(phrase):
        at = at[ids[at + k] == w]
    return at[doc_of(at) == doc_of(at + len(phrase) - 1)] if len(at) else at


class Template:
    """A template's words, its postings (word -> positions), and its words' weights under an IDF."""

    def __init__(self, label: str, text: str, key: str, idf: np.ndarray):
        self.label = label
        self.words = np.array([ID_OF[w] for w in _words(text)])
        self.key = np.array([ID_OF[w] for w in _words(key)])
        self.weight = idf[self.words]
        self.total = float(self.weight.sum())
        self.postings = {int(w): np.flatnonzero(self.words == w) for w in np.unique(self.words)}
        self.rarest = sorted(self.postings, key=lambda w: (-idf[w], w))

    def starts(self, places: dict[int, np.ndarray], idf: np.ndarray) -> np.ndarray:
        """Relative positions (template start in the document) at which COVERAGE can be reached."""
        held = [w for w in self.rarest if w in places]
        absent = self.total - sum(idf[w] * len(self.postings[w]) for w in held)
        spare = (1 - COVERAGE) * self.total - absent  # what may be out of place besides
        if spare < -1e-9:
            return np.zeros(0, np.int64)
        looked_up, at, weight = 0.0, [], []
        for w in held:
            if looked_up >= LOOKED_UP * self.total and looked_up > spare + 1e-9:
                break
            met = (places[w][:, None] - self.postings[w]).ravel()
            at.append(met)
            weight.append(np.full(len(met), idf[w]))
            looked_up += idf[w] * len(self.postings[w])
        starts, of = np.unique(np.concatenate(at), return_inverse=True)
        return starts[np.bincount(of, np.concatenate(weight)) >= looked_up - spare - 1e-9]

    def score(self, words: np.ndarray, places: dict[int, np.ndarray], idf: np.ndarray) -> float:
        """The best IDF share among the alignments with one document's words that hold the key phrase; 0 if there is none."""
        starts = self.starts(places, idf)
        key = places.get(int(self.key[0]), starts[:0])
        for k, w in enumerate(self.key):
            key = key[key + k < len(words)]
            key = key[words[key + k] == w]
        if not len(starts) or not len(key):
            return 0.0
        nearest = np.searchsorted(key, starts)
        found = key[np.minimum(nearest, len(key) - 1)]
        starts = starts[(nearest < len(key)) & (found + len(self.key) <= starts + len(self.words))]
        best = 0.0
        for some in np.array_split(starts, max(1, len(starts) // 4096)):
            spots = some[:, None] + np.arange(len(self.words))
            same = (spots >= 0) & (spots < len(words)) & (words[np.clip(spots, 0, len(words) - 1)] == self.words)
            best = max(best, float((same @ self.weight).max(initial=0.0)) / self.total)
        return min(best, 1.0) if best >= COVERAGE - 1e-12 else 0.0


def _candidates(ids: np.ndarray, first: np.ndarray, mass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, template) pairs where the document's words hold COVERAGE of the template's IDF; mass: templates x words, shares."""
    where = np.flatnonzero(ids >= 0)
    doc = np.searchsorted(first, where, "right") - 1
    pairs = np.unique(doc * len(WORDS) + ids[where])
    doc, word = pairs // len(WORDS), pairs % len(WORDS)
    known = np.unique(doc)
    held = np.zeros((len(known), len(mass)))
    np.add.at(held, np.searchsorted(known, doc), mass.T[word])
    at, template = np.nonzero(held >= COVERAGE - 1e-9)
    return known[at], template


def _scan(idf_list: list[float]):
    idf = np.array(idf_list)
    base = [([ID_OF[w] for w in p.split()], label) for p, label in BASE]
    base = [(p, int(np.argmax(idf[p])), label) for p, label in base]

    def scan(batches):
        forms = [Template(label, text, key, idf) for label, text, key in TEMPLATES]
        mass = np.stack([np.bincount(f.words, f.weight, len(WORDS)) / f.total for f in forms])
        for batch in batches:
            out = {k: [] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")}
            for i, j, ids, first in _pieces(batch):
                n = j - i

                def doc_of(at, first=first):
                    return np.searchsorted(first, at, "right") - 1

                n_base = np.zeros(n, np.int64)
                low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
                base_names: list[set] = [set() for _ in range(n)]
                names: list[set] = [set() for _ in range(n)]
                score = np.zeros(n)
                for phrase, anchor, label in base:
                    at = _places(ids, doc_of, phrase, anchor)
                    doc = doc_of(at)
                    np.add.at(n_base, doc, 1)
                    np.minimum.at(low, doc, at - first[doc])
                    np.maximum.at(high, doc, at - first[doc])
                    for d in np.unique(doc):
                        base_names[d].add(label)
                        names[d].add(label)
                now, words, places = -1, ids, {}
                for d, t in zip(*_candidates(ids, first, mass)):
                    if d != now:
                        now, words = d, ids[first[d] : first[d + 1]]
                        order = np.argsort(words, kind="stable")
                        held, begin = np.unique(words[order], return_index=True)
                        places = dict(zip(held.tolist(), np.split(order, begin[1:])))
                    got = forms[t].score(words, places, idf)
                    if got:
                        names[d].add(forms[t].label)
                        score[d] = max(score[d], got)
                out["n_words"].extend(np.diff(first).tolist())
                out["n_base"].extend(n_base.tolist())
                out["first_word"].extend(x if c else None for x, c in zip(low.tolist(), n_base))
                out["last_word"].extend(x if c else None for x, c in zip(high.tolist(), n_base))
                out["base_labels"].extend(",".join(sorted(x)) for x in base_names)
                out["labels"].extend(",".join(sorted(x)) for x in names)
                out["score"].extend(score.tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(out[k], t) for k, t in (("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())))],
                names=["doc_id", *out],
            )

    return scan


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Per document: n_words, n_base, first_word, last_word, base_labels, labels, score."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body().alias("text"))
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return rows.mapInArrow(_scan(inverse_frequencies(docs)), schema)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_documents(spark, sf_dir))
