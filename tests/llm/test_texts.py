"""Encoding, fingerprints, chats, licences, packing and the classifier."""

import hashlib
import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.llm import chat, licenses, order_minhash, packing, pieces, quality
from tideline.llm.common import row_key

from .test_dedup import brute_groups, brute_print


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


needs_model = pytest.mark.skipif(not Path(pieces.MODEL).exists(), reason="no public model file")


@needs_model
def test_viterbi_matches_the_library():
    """Against a unigram model of the same pieces, all of them, and scores; where paths tie, their scores are equal."""
    sp = pytest.importorskip("sentencepiece")
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    codec = pieces.load()
    model = pb.ModelProto()
    model.ParseFromString(Path(pieces.MODEL).read_bytes())
    model.trainer_spec.model_type = 1
    for i, p in enumerate(model.pieces):
        p.score = float(codec.scores[i])
    other = sp.SentencePieceProcessor(model_proto=model.SerializeToString())
    texts = ["Hello  world", "the of\n\nand été", "漢字 🙂 \x00\x01", "a", " ", "\n", "*** $$$ !!!", "supercalifragilistic " * 40, "ünter den Linden, près de l'été"]
    for text, ids in zip(texts, codec.encode(texts, {})):
        want = other.encode(text)
        value = lambda x: sum(codec.scores[i] for i in x)
        assert list(ids) == want or (len(ids) == len(want) and abs(value(ids) - value(want)) < 1e-2), text
        assert codec.decode(ids) == text


@needs_model
def test_runs_of_spaces_match_the_library():
    """Against the model's unchanged set of pieces, runs of markers among them."""
    sp = pytest.importorskip("sentencepiece")
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    codec = pieces.load()
    model = pb.ModelProto()
    model.ParseFromString(Path(pieces.MODEL).read_bytes())
    model.trainer_spec.model_type = 1
    for i, p in enumerate(model.pieces):
        p.score = float(codec.scores[i])
    other = sp.SentencePieceProcessor(model_proto=model.SerializeToString())
    value = lambda x: sum(codec.scores[i] for i in x)
    texts = [t for n in range(2, 21) for t in (f"a{' ' * n}b", f"{' ' * n}return x\n{' ' * n}y = 1", f"end{' ' * n}", " " * n)]
    runs = {i for i, p in enumerate(model.pieces) if p.type == 1 and pieces.MARK in p.piece[1:]}
    used = set()
    for text, ids in zip(texts, codec.encode(texts, {})):
        want = other.encode(text)
        assert list(ids) == want or (len(ids) == len(want) and abs(value(ids) - value(want)) < 1e-2), text
        assert codec.decode(ids) == text
        used |= runs & set(ids.tolist())
    assert used


@needs_model
def test_encode_documents(docs, rows, no_docs):
    out = pieces.decode_documents(pieces.encode_documents(docs)).collect()
    assert len(out) == len(rows) and all(r.decoded == r.text for r in out)
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)  # repeated rows repeat
    assert {r.n_ids for r in out if not r.text} == {0}
    assert pieces.encode_documents(no_docs).count() == 0


def test_order_minhash(docs, rows, no_docs):
    order = sorted(rows, key=lambda r: -(1 << 63) if r[0] is None else r[0])
    found = {(r.doc_id, r.n_chars): r for r in order_minhash.fingerprints(docs).collect()}
    by_id = {}
    for r in rows:
        by_id.setdefault(r[0], []).append(r[1] or "")
    prints = {}
    for k, r in enumerate(order):
        text = r[1] or ""
        row = found[(r[0], len(text))]
        prints.setdefault(text, set()).add(row.fingerprint)
        after = order[(k + 1) % len(order)]
        if len(by_id[r[0]]) == 1 and len(by_id[after[0]]) == 1:
            n, following = len(text), after[1] or ""
            assert row.edited_sha256 == sha(text[: n - n // 2] + following[: n // 2])
    assert all(len(x) == 1 for x in prints.values())
    assert order_minhash.fingerprints(no_docs).count() == 0
    one = order_minhash.fingerprints(docs.filter("doc_id = 12")).first()
    assert one.near_next == 1.0


def brute_signature(text, k=8, bins=128, size=2):
    """Selection and order with dictionaries and lists; only the hashes of single k-mers are the operator's."""
    mix, odd = order_minhash.mix, order_minhash._ODD
    codes = np.array([ord(c) + 1 for c in text], np.uint64)
    prefix = order_minhash.prefixes(codes)
    n = max(1, len(text) - k + 1)
    hash_of = [int(order_minhash.spans_hash(prefix, np.array([i]), np.array([min(i + k, len(text))]))[0]) for i in range(n)]
    seen, every, dealt = Counter(), [], [[] for _ in range(bins)]
    for i, h in enumerate(hash_of):
        key = int(order_minhash.mix(np.array([h], np.uint64) + np.array([seen[h]], np.uint64) * order_minhash._ODD)[0])
        seen[h] += 1
        every.append((key, i))
        dealt[key * bins >> 64].append((key, i))
    out = []
    for b in range(bins):
        if len(dealt[b]) < min(size, n):
            salt = mix(np.array([b + 1], np.uint64) * odd)
            dealt[b] = [(int(mix(np.array([key], np.uint64) + salt)[0]), i) for key, i in every]
        places = sorted(i for _, i in sorted(dealt[b])[:size])
        value = np.zeros(1, np.uint64)
        for i in places:
            value = order_minhash.mix(value * order_minhash._ODD + np.array([hash_of[i]], np.uint64) + np.uint64(1))
        out.append(int(value[0]) >> 48)
    return out


def test_order_minhash_against_brute_force(spark):
    """Fingerprints, edited texts and both likenesses of texts of every length, as the query gives them."""
    rng = random.Random(12)
    text = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    texts = ["", "a", "seven77", "eightchr", text(9), text(10), text(40), text(130), text(400), text(1500), "ab" * 200, text(260)]
    texts += [texts[8][:200] + texts[8][201:], texts[9][700:] + texts[9][:700]]
    table = spark.createDataFrame([(3 * i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    want = [brute_signature(t) for t in texts]
    like = lambda a, b: sum(x == y for x, y in zip(a, b)) / len(a)
    show = lambda s: "".join(f"{x:04x}" for x in s)
    for i, r in enumerate(order_minhash.fingerprints(table).orderBy("doc_id").collect()):
        j, n = (i + 1) % len(texts), len(texts[i])
        edited = texts[i][: n - n // 2] + texts[j][: n // 2]
        assert (r.n_chars, r.fingerprint, r.edited_sha256) == (n, show(want[i]), sha(edited))
        assert r.edited_fingerprint == show(brute_signature(edited))
        assert r.near_edited == like(want[i], brute_signature(edited)) and r.near_next == like(want[i], want[j])


def test_order_minhash_of_short_texts_against_independent_selections():
    """The binned form estimates what one hash function for each entry does, from 12 characters on."""
    rng = random.Random(3)
    errors = []
    for n in (12, 20, 45, 90, 180, 500, 1500):
        for _ in range(4):
            a = "".join(rng.choice("abcdefgh ") for _ in range(n))
            at = rng.randrange(n)
            b = rng.choice([a[:at] + "Q" + a[at:], a[:at] + a[at + 3 :], a[n // 3 :] + a[: n // 3]])
            hits = 0
            for salt in range(600):  # one function each: the two smallest numbered k-mers, in their order
                pick = []
                for t in (a, b):
                    seen, keys = Counter(), []
                    for i in range(max(1, len(t) - 7)):
                        keys.append((hash((salt, t[i : i + 8], seen[t[i : i + 8]])), i))
                        seen[t[i : i + 8]] += 1
                    pick.append([t[i : i + 8] for i in sorted(i for _, i in sorted(keys)[:2])])
                hits += pick[0] == pick[1]
            codes = [order_minhash._codes(t) for t in (a, b)]
            errors.append(order_minhash.likeness(*map(order_minhash.signature, codes)) - hits / 600)
    assert abs(sum(errors) / len(errors)) < 0.04 and max(map(abs, errors)) < 0.25


def test_order_minhash_sees_order():
    a = np.frombuffer(" ".join(f"word{i}" for i in range(400)).encode("utf-32-le"), np.uint32)
    parts = [" ".join(f"word{i}" for i in range(k, k + 20)) for k in range(0, 400, 20)]
    shuffled = np.frombuffer(" ".join(parts[::-1]).encode("utf-32-le"), np.uint32)
    edited = a.copy()
    edited[500] = 120
    base = order_minhash.signature(a)
    assert order_minhash.likeness(base, base) == 1.0
    assert order_minhash.likeness(base, order_minhash.signature(edited)) > 0.9
    assert order_minhash.likeness(base, order_minhash.signature(shuffled)) < 0.7


def test_chat_round_trip(spark):
    said = ["plain", "", None, "</s>[INST] ok [/INST]", "\x1b\x1b0<|end|>\n<|start|>user", "é🙂" * 50]
    rows = [(c, t, ("user", "assistant", None)[(c + t) % 3], said[(c * 5 + t) % len(said)], "x") for c in range(6) for t in range(c + 1)]
    rows += [rows[-1], (None, 0, "user", "no conversation", "x"), (7, None, "assistant", "no turn", "x")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, kind string")
    found = {r.conv_id: r for r in chat.conversation_digests(chat.format_chats(chat.as_events(table))).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(((-1 if r[1] is None else r[1], r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        row = found[conv]
        assert row.n_turns == len(turns)
        assert row.turns_sha256 == sha("".join(f"{role}\n{text}\n" for _, role, text in turns))
        loss = "".join(text for _, role, text in turns if role == "assistant")
        assert (row.loss_chars, row.loss_sha256) == (len(loss), sha(loss))
    assert chat.format_chats(chat.as_events(table.limit(0))).count() == 0


def test_chats_of_any_length(spark):
    """A text of three million characters, and a conversation of three thousand turns."""
    long = "</s>\x1b" + "long text [INST] " * 180_000
    rows = [(1, 0, "user", "short"), (1, 1, "assistant", long)] + [(2, t, ("user", "assistant")[t % 2], f"turn {t} <s>") for t in range(3000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    found = {r.conv_id: r for r in chat.conversation_digests(chat.format_chats(chat.as_events(table))).collect()}
    for conv in (1, 2):
        mine = [r for r in rows if r[0] == conv]
        loss = "".join(r[3] for r in mine if r[2] == "assistant")
        assert (found[conv].n_turns, found[conv].loss_chars, found[conv].loss_sha256) == (len(mine), len(loss), sha(loss))
        assert found[conv].turns_sha256 == sha("".join(f"{r[2]}\n{r[3]}\n" for r in mine))


def test_chat_fold(spark):
    """Events of two messages woven into each other; an edit and a regeneration that come after a later message."""
    log = [(1, 4, 0, "delta", "a", "old"), (1, 0, 0, "start", "a", ""), (1, 2, 1, "delta", "u", "x"), (1, 1, 1, "start", "u", ""), (1, 3, 1, "edit", "u", "y"), (1, 5, 5, "start", "a", ""), (1, 6, 5, "delta", "a", "last"), (1, 7, 0, "regenerate", "a", ""), (1, 8, 0, "delta", "a", "new"), (1, 9, 1, "delta", "u", "z"), (1, 10, 0, "delta", "a", "er"), (1, 11, None, "start", None, None), (2, 0, 7, "delta", "a", "no start")]
    out = [(r.conv_id, r.ref, r.role, r.text) for r in chat.fold(spark.createDataFrame(log, chat.EVENTS)).orderBy("conv_id", "ref").collect()]
    assert out == [(1, 0, "a", "newer"), (1, 1, "u", "yz"), (1, 5, "a", "last"), (1, 11, "", ""), (2, 7, "", "no start")]


def test_messages_stand_in_the_order_of_the_log(spark):
    """Random logs, shuffled, against a fold event by event: what comes first is what the sequence starts first."""
    rng = random.Random(12)
    log, want = [], {}
    for conv in (None, 1, 2, 3):
        messages, seq = {}, rng.randint(-50, 50)
        for _ in range(rng.randint(1, 60)):
            seq += rng.randint(1, 9)
            kind = rng.choice(("start", "delta", "delta", "edit", "regenerate")) if messages else "start"
            ref = seq if kind == "start" else rng.choice(list(messages))
            role, text = rng.choice(("user", "assistant")), rng.choice(("", "</s>", "some words ", "\n", "é"))
            log.append((conv, seq, ref, kind, role, text))
            if kind == "start":
                messages[ref] = [role, ""]
            else:
                messages[ref][1] = messages[ref][1] + text if kind == "delta" else text if kind == "edit" else ""
        want[conv] = [messages[k] for k in sorted(messages)]
    rng.shuffle(log)
    events = spark.createDataFrame(log, chat.EVENTS).repartition(3)
    found = {r.conv_id: r for r in chat.conversation_digests(chat.format_chats(events)).collect()}
    for conv, turns in want.items():
        assert (found[conv].n_turns, found[conv].turns_sha256) == (len(turns), sha("".join(f"{role}\n{text}\n" for role, text in turns)))
        assert found[conv].loss_sha256 == sha("".join(text for role, text in turns if role == "assistant"))


def test_licenses(docs, rows, no_docs):
    out = {(r.doc_id, r.n_words): r for r in licenses.scan_licenses(docs).collect()}
    for r in rows:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1] or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
        at = {(i, label) for p, label in licenses.BASE for i in range(len(words)) if words[i : i + len(p.split())] == p.split()}
        row = out[(r[0], len(words))]
        assert row.n_base == len(at) and row.base_labels == ",".join(sorted({x for _, x in at}))
        assert (row.first_word, row.last_word) == ((min(i for i, _ in at), max(i for i, _ in at)) if at else (None, None))
        assert set(row.base_labels.split(",")) <= set(row.labels.split(",")) | {""}
    assert any("mit-notice" in r.labels and r.score > 0.99 for r in out.values())
    assert licenses.scan_licenses(docs).count() == len(rows)  # repeated rows repeat
    assert licenses.scan_licenses(no_docs).count() == 0


def brute_license(words, idf):
    """(labels of the templates, best score): every template at every place, word by word."""
    labels, best = set(), 0.0
    for label, text, key in licenses.TEMPLATES:
        form, key = licenses._words(text), key.split()
        total = sum(idf[w] for w in form)
        if sum(idf[w] for w in form if w in words) < 0.8 * total - 1e-9:
            continue  # no place can reach it
        for s in range(-len(form), len(words) + 1):
            got = sum(idf[w] for k, w in enumerate(form) if 0 <= s + k < len(words) and words[s + k] == w) / total
            inside = range(max(s, 0), min(s + len(form), len(words)) - len(key) + 1)
            if got >= 0.8 and any(words[i : i + len(key)] == key for i in inside):
                labels.add(label)
                best = max(best, got)
    return labels, best


def test_license_templates_against_brute_force(spark):
    """Whole texts, texts with words lost, put in, changed or cut off, and several licences in a file."""
    rng = random.Random(4)
    filler = lambda n: [rng.choice(["the", "of", "software", "x", "license", "copy", "zz9"]) for _ in range(n)]
    files = [[], ["mit", "license"], filler(200)]
    for _, text, _ in licenses.TEMPLATES:
        form = licenses._words(text)
        files.append(filler(9) + form + filler(4))
        at = rng.randrange(len(form))
        files += [form[:at] + form[at + 1 :], form[:at] + ["added"] + form[at:], form[: int(0.85 * len(form))], form[len(form) // 6 :]]
        files.append([w if rng.random() < 0.93 else "other" for w in form] * 2)
    files.append([w for _, text, _ in licenses.TEMPLATES[::3] for w in licenses._words(text) + filler(3)])
    docs = spark.createDataFrame([(i, " ".join(w).upper()) for i, w in enumerate(files)], "doc_id long, text string").repartition(3)
    idf = dict(zip(licenses.WORDS, licenses.inverse_frequencies(docs)))
    base = {label for _, label in licenses.BASE}
    found = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    several = 0
    for i, words in enumerate(files):
        labels, best = brute_license(words, idf)
        assert set(found[i].labels.split(",")) - base - {""} == labels, (i, words[:8])
        assert abs(found[i].score - best) < 1e-9
        several += len(labels) > 2
    assert several and {x for r in found.values() for x in r.labels.split(",")} >= {t[0] for t in licenses.TEMPLATES}


def brute_pack(items, capacity, per_source):
    bins = []
    out = []
    for length, source, cluster in items:
        fit = [b for b in range(len(bins)) if bins[b][0] >= length and cluster not in bins[b][1] and bins[b][2].count(source) < per_source]
        b = min(fit, key=lambda x: (bins[x][0], x), default=None)
        if b is None:
            b = len(bins)
            bins.append([capacity, set(), []])
        out.append((b, capacity - bins[b][0]))
        bins[b][0] -= length
        bins[b][1].add(cluster)
        bins[b][2].append(source)
    return out


def test_best_fit_is_best_fit():
    rng = np.random.default_rng(1)
    items = sorted(((int(n), int(s), int(c)) for n, s, c in zip(rng.integers(0, 101, 400), rng.integers(0, 5, 400) // 2, rng.integers(0, 150, 400))), key=lambda x: -x[0])
    assert packing.pack(items, 100, 2) == brute_pack(items, 100, 2)


def test_pack_documents(docs, rows, no_docs):
    out = packing.pack_documents(docs, 100, 2).collect()
    assert sum(r.length for r in out) == sum(len((r[1] or "").split()) for r in rows)
    for bin_id in {r.bin_id for r in out}:
        inside = sorted((r.offset, r.length) for r in out if r.bin_id == bin_id)
        assert sum(n for _, n in inside) <= 100 and {r.bin_fill for r in out if r.bin_id == bin_id} == {sum(n for _, n in inside)}
        assert all(a + n <= b for (a, n), (b, _) in zip(inside, inside[1:]))
    assert packing.pack_documents(no_docs).count() == 0


def test_pack_documents_against_brute_force(docs, rows):
    """One group of documents: near copies of SimHash are clusters, parts beyond a bin fill bins of their own."""
    codes = [brute_print(r[1]) for r in rows]
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    groups = brute_groups(codes, 3)
    root = [min(signed[i] for i, h in enumerate(groups) if h == g) for g in groups]
    items = [(len((r[1] or "").split()), r[3] or "", c, r[0]) for r, c in zip(rows, root)]
    items.sort(key=lambda x: (-x[0], -1 if x[3] is None else x[3], x[2], x[1]))
    rest = []
    for n, source, cluster, doc in items:
        full = (n - 1) // 100 if n else 0
        rest.append((n - 100 * full, source, cluster, doc, full))
    rest.sort(key=lambda x: -x[0])
    placed = brute_pack([x[:3] for x in rest], 100, 2)
    fill = {}
    for (n, *_), (b, _) in zip(rest, placed):
        fill[b] = fill.get(b, 0) + n
    want = [(doc, full, n, at, fill[b]) for (n, _, _, doc, full), (b, at) in zip(rest, placed)]
    want += [(doc, part, 100, 0, 100) for *_, doc, full in rest for part in range(full)]
    found = [(r.doc_id, r.part, r.length, r.offset, r.bin_fill) for r in packing.pack_documents(docs, 100, 2).collect()]
    assert Counter(found) == Counter(want)


def test_lengths_are_counted_over_bytes(spark):
    """Words of texts that stand end to end, against split; no regular expression rewrites the texts in the JVM."""
    texts = ["a b", "", " c", "d", "\x0b \x1f\u00a0x\u2003y\x0c", "\r\n", None, "é ü\té", "end "]
    table = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string").coalesce(1)
    clusters = spark.createDataFrame([], "key long, cluster long")
    lots = packing._lots(table, clusters)
    assert {r.doc_id: r.length for r in lots.collect()} == {i: len((t or "").encode().split()) for i, t in enumerate(texts)}
    raw = "".join(t or "" for t in texts).encode()
    ends = np.cumsum([0, *(len((t or "").encode()) for t in texts)])
    assert packing.word_counts(np.frombuffer(raw, np.uint8), ends).tolist() == [len((t or "").encode().split()) for t in texts]


def test_pack_with_clusters_of_the_caller(spark):
    table = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"), F.col("id").cast("string").alias("source"))
    clusters = table.select(row_key().alias("key"), (F.col("doc_id") % 4).alias("cluster"))
    out = packing.pack_documents(table, clusters=clusters).collect()
    bins = {}
    for r in out:
        bins.setdefault(r.bin_id, []).append(r.doc_id % 4)
    assert len(bins) == 10 and all(sorted(x) == [0, 1, 2, 3] for x in bins.values())


def test_pack_a_row_repeated_often(spark):
    table = spark.range(700).select(F.lit(3).alias("doc_id"), F.lit("two words").alias("text"), F.lit("s").alias("source"))
    out = packing.pack_documents(table).collect()
    assert len(out) == 700 == len({r.bin_id for r in out}) and all(r.bin_fill == 2 for r in out)  # copies never share a bin


def test_quality(spark, docs, rows, no_docs):
    rng = np.random.default_rng(5)
    good = [(1000 + i, " ".join("theonandreer"[k % 9 : k % 9 + 4] for k in rng.integers(0, 9, 60)) + ".") for i in range(120)]
    bad = [(2000 + i, " ".join(f"{'xyz'[k % 3]}!!" for k in rng.integers(0, 9, 60))) for i in range(30)]
    table = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 2000), 0) for i, _ in good[:80] + bad], "doc_id long, quality int, toxic int")
    model = quality.fit(table, labels)
    assert 0.05 <= model["prior"] <= 0.99
    scores = {r.doc_id: r.score for r in quality.score(table, model).collect()}
    assert min(s for i, s in scores.items() if i < 2000) > max(s for i, s in scores.items() if i >= 2000)
    odd = quality.score(docs, model)
    assert odd.count() == len(rows) and odd.filter("score between 0 and 1").count() == len(rows)
    kept = quality.accepted(docs, labels)
    assert kept.schema == docs.schema
    assert quality.score(no_docs, quality.fit(no_docs, labels.limit(0))).count() == 0


def test_no_labels_of_the_held_out_fold(spark):
    table = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    labels = table.select("doc_id", F.lit(1).alias("quality")).filter(quality.fold() == quality.HELD_OUT)
    assert quality.fit(table, labels) is None
