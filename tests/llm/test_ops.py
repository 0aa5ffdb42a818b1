"""Operators against brute force on small tables with nulls, empty and long texts, ties, repeated rows and extra columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspan.llm import bwt_lcp, chat, components, decontamination, fm_index, gru, lm_scoring, packing, packing_plan, pii, quality, sharding, simhash, substring_dedup, token_counts

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, count long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts():
    r = random.Random(5)
    words = ["".join(r.choice("abcdeéñ日") for _ in range(r.randint(1, 7))) for _ in range(300)]
    say = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage = say(60)
    out = {1: None, 2: "", 3: " \n\t ", 4: "Hello World.", 5: say(3000), 6: "x" * 5000, 7: "ab " * 700, 8: passage, 9: say(30) + " " + passage + " " + say(20), 10: say(25) + " " + passage}
    out |= {20 + i: say(80) for i in range(10)}
    out |= {40: out[20], 41: out[20], 42: out[21].replace(words[0], words[1]), 43: "a b c", 44: "### $$$ " * 40, 45: "\n".join(["same line here"] * 30), 46: say(400) + "\r\n" + say(10), 47: out[20] + " end"}
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(k, t, "en", "s", len(t or ""), "k", 1) for k, t in texts.items()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_token_counts(docs, empty, texts):
    path = token_counts.model_path("piece_bpe_32k.model")
    model = token_counts.PieceCounter(path).model
    for chunk, overlap in ((64, 4), (token_counts.CHUNK_CHARS, 256)):
        got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(docs, path, limit=900, chunk=chunk, overlap=overlap).collect()}
        want = {k: (len((t or "").encode()), n := len(model.encode(t or "")), n > 900) for k, t in texts.items()}
        assert got == want
    assert token_counts.count_tokens(empty, path).count() == 0


def test_stable_boundaries_are_proven():
    c = token_counts.PieceCounter(token_counts.model_path("piece_bpe_32k.model"), 50, 5)
    assert not c.stable("a b", 2) and c.stable("a b", 1)
    r = random.Random(1)
    for _ in range(60):
        t = "".join(r.choice("ab c\n日é😀.") for _ in range(r.randint(51, 400)))
        assert c.count(t) == len(c.model.encode(t))


def test_sharding(spark, docs, empty, texts):
    rows = sharding.shard_rows(docs.unionAll(docs.limit(5)), shards=4, salts=3).collect()
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(rows) == len(texts) + 5
    for s in sizes:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))
    by_id = {r.doc_id: r for r in rows}
    assert all(by_id[k].size == len((t or "").encode()) + 1 and by_id[k].text_crc32 == zlib.crc32((t or "").encode()) for k, t in texts.items())
    assert sharding.shard_rows(empty).count() == 0
    hot = spark.range(4000).selectExpr("id as doc_id", "if(id % 3 = 0, 'same', cast(id as string)) as text")
    n = Counter(r.shard for r in sharding.shard_rows(hot).collect())
    assert set(n.values()) == {500}


def test_arc_plan_moves_only_overflow():
    plan = sharding.place_arcs({0: 10, 1: 1, 2: 1}, [0, 1, 2], 3)
    assert sum(p[2] for p in plan) == 12 and [p for p in plan if p[0] == 0][0][3] == 0
    assert sharding.arc_of(5, [1, 5, 9]) == 1 and sharding.arc_of(10, [1, 5, 9]) == 0


def test_simhash_groups(spark, docs, empty, texts):
    got = {r.doc_id: (r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    ids = sorted(texts)
    prints = np.array([simhash.fingerprint(texts[i]) for i in ids], np.uint64)
    forest = simhash.Forest(len(ids))
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= 4):
            forest.join(i, i + 1 + int(j))
    assert got == {k: (int(prints[i]), ids[forest.find(i)]) for i, k in enumerate(ids)}
    assert got[2][0] == 0 and got[41][1] == 20
    assert simhash.near_duplicates(empty).count() == 0


def similar(a, b):
    """Jaccard similarity of the sets of five-word shingles."""
    x, y = ({" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := WORD.findall((t or "").lower())) else set() for t in (a, b))
    return len(x & y) / len(x | y) if x | y else 1.0


def similar_groups(texts):
    """The smallest key of each group of texts that pairs with a similarity of 0.8 or more connect."""
    ids = sorted(texts)
    forest = simhash.Forest(len(ids))
    for i in range(len(ids)):
        for j in range(i):
            if similar(texts[ids[i]], texts[ids[j]]) >= 0.8:
                forest.join(i, j)
    return {k: ids[forest.find(i)] for i, k in enumerate(ids)}


def test_similar_texts_leave_one(spark, docs, empty, texts):
    want = similar_groups(texts)
    assert want[41] == 20 and want[47] == 20 and want[10] == 10
    kept = simhash.drop_near_duplicates(docs.unionAll(docs))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values())) and kept.columns == docs.columns
    assert simhash.drop_near_duplicates(empty).count() == 0


def test_similarity_limit_and_recall(spark):
    """Texts with planted similarities: no pair below 0.8 is joined, nearly all from 0.8 on are; one large group of near copies."""
    r = random.Random(12)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    texts, pairs, n = {}, [], 0
    for i in range(120):
        a = [word() for _ in range(r.choice([30, 80, 200, 900]))]
        b = list(a)
        for at in r.sample(range(len(b)), max(1, round(len(b) * r.choice([0.005, 0.015, 0.02, 0.03, 0.06])))):
            b[at] = word()
        texts[n], texts[n + 1] = " ".join(a), " ".join(b)
        pairs.append((n, n + 1))
        n += 2
    near = [word() for _ in range(150)]
    hot = range(n, n + 150)
    for k in hot:
        own = list(near)
        own[r.randrange(150)] = word()
        texts[k] = " ".join(own)
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    found = {x.doc_id: x.group for x in simhash.similar_groups(rows).collect()}
    alike = [similar(texts[a], texts[b]) >= 0.8 for a, b in pairs]
    linked = [found[a] == found[b] for a, b in pairs]
    assert not any(x and not y for x, y in zip(linked, alike, strict=True)) and 30 < sum(alike) < 110
    assert sum(linked) >= 0.85 * sum(alike) and {found[k] for k in hot} == {hot[0]}
    assert len({found[a] for a, _ in pairs}) == 120


def test_near_duplicates_without_or_with_repeated_ids(spark):
    r = random.Random(13)
    a, b, c = (" ".join("".join(r.choice("abcdef") for _ in range(5)) for _ in range(60)) for _ in range(3))
    rows = spark.createDataFrame([(None, a, 1), (None, a, 2), (7, b, 3), (7, c, 4), (7, c, 5), (None, b, 6), (None, None, 7), (9, " ", 8), (None, "x", 9)], "doc_id long, text string, _kept int")
    kept = simhash.drop_near_duplicates(rows)
    assert sorted((x.doc_id or 0, x.text) for x in kept.collect()) == sorted([(0, a), (7, b), (7, c), (9, " "), (0, "x")]) and kept.columns == rows.columns
    got = {(x.doc_id, x.fp, x.component_id) for x in simhash.near_duplicates(rows.drop("_kept")).collect()}
    signed = lambda t: (f := simhash.fingerprint(t)) - (f >> 63 << 64)
    assert got == {(None, signed(a), None), (7, signed(b), 7), (7, signed(c), 7), (None, signed(b), 7), (None, 0, 9), (9, 0, 9), (None, signed("x"), None)}


@pytest.mark.parametrize("n", [6, 7, 8])
def test_blocks_find_four_bits_and_not_five(spark, n):
    r = random.Random(n)
    rows, want = [], {}
    for i in range(60):
        base = r.getrandbits(64)
        for k, bits in enumerate((0, 4, 5)):
            f = base ^ sum(1 << b for b in r.sample(range(64), bits))
            rows.append((3 * i + k, f - (f >> 63 << 64)))
            want[3 * i + k] = f
    prints = spark.createDataFrame(rows, "rep long, fp long").repartition(3)
    found = {(min(x.u, x.v), max(x.u, x.v)) for x in simhash.links(prints, F.array(*simhash.block_keys(n))).collect()}
    assert found == {(a, b) for a in want for b in want if a < b and (want[a] ^ want[b]).bit_count() <= 4} and (0, 1) in found and (0, 2) not in found


def test_simhash_bits_by_definition():
    import xxhash

    t = "One two THREE four five six two three four five"
    w = WORD.findall(t.lower())
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(len(w) - 3)]
    assert simhash.fingerprint(t) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_hot_buckets_are_split(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 40)
    r = random.Random(3)
    base = r.getrandbits(64)
    fps = {base ^ sum(1 << b for b in r.sample(range(64), r.choice([1, 2, 4, 9]))) for _ in range(400)}
    rows = [(i, f - 2**64 if f >= 2**63 else f) for i, f in enumerate(sorted(fps))]
    prints = spark.createDataFrame(rows, "rep long, fp long")
    roots = {x.node: x.root for x in components.components(simhash.links(prints, F.array(*simhash.block_keys()))).collect()}
    a = np.array([f for f in sorted(fps)], np.uint64)
    forest = simhash.Forest(len(a))
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1 :] ^ a[i]) <= 4):
            forest.join(i, i + 1 + int(j))
    assert all(roots.get(i, i) == forest.find(i) for i in range(len(a)))


def test_components(spark):
    r = random.Random(4)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    forest = simhash.Forest(2000)
    for a, b in edges:
        forest.join(a, b)
    got = {x.node: x.root for x in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    nodes = {x for e in edges for x in e}
    assert {n: got.get(n, n) for n in nodes} == {n: forest.find(n) for n in nodes}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def chats(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, k long")


def test_chat_snapshots(spark):
    rows = [(1, 0, "user", "hi", 1), (2, 0, "human", "hi", 1), (2, 1, "gpt", "yo <|end|>", 1), (3, 0, "user", "hi", 1), (3, 1, "assistant", "yo <|end|>", 1), (4, None, None, None, 1), (4, 7, "user", "x", 1), (5, 5000, "user", "late", 1), (5, 1, "user", "early", 1), (None, 1, "user", "lost", 1), (6, 1, "user", "a", 1), (6, 1, "user", "a", 1)]
    got = {(r.conv_id, r.part): (r.first_turn, r.n_turns, r.n_copies, r.text) for r in chat.format_chats(chats(spark, rows)).collect()}
    assert (1, 0) not in got and (3, 0) not in got
    assert got[2, 0] == (1, 2, 2, "<|user|>\nhi<|end|>\n<|assistant|>\nyo < |end|><|end|>\n")
    assert got[5, 0][3].startswith("<|user|>\nearly") and got[5, 4][:2] == (2, 2)
    assert got[4, -(2**62)][3] == "<|unknown|>\n<|end|>\n" and got[6, 0][1] == 2
    assert chat.format_chats(chats(spark, [])).count() == 0


def measures(t):
    w = WORD.findall(t or "")
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    n = Counter(windows)
    covered = {j for i, x in enumerate(windows) if n[x] > 1 for j in range(i, i + 8)}
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered)


def test_quality(docs, empty, texts):
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.measure(docs).collect()}
    assert got == {k: measures(t) for k, t in texts.items()}
    kept = {r.doc_id for r in quality.filter_documents(docs).collect()}

    def good(k):
        n, chars, symbols, dup, repeat = got[k]
        lines = sum(bool(WORD.search(x)) for x in (texts[k] or "").split("\n"))
        w = WORD.findall(texts[k] or "")
        stutter = sum(a == b for a, b in zip(w, w[1:], strict=False))
        return n >= 20 and 100 * repeat <= 30 * n and 100 * symbols <= 5 * chars and not (lines >= 4 and 100 * dup > 50 * lines) and chars <= 40 * n and 100 * stutter <= 30 * n

    assert kept == {k for k in texts if good(k)} and {20, 9} <= kept and not kept & {1, 2, 3, 44, 45, 7}
    assert quality.filter_documents(docs).columns == docs.columns and quality.filter_documents(empty).count() == 0
    conditions = quality.lazy_rules(quality.Limits())
    assert sorted(quality.cascade_order(docs, conditions)) == sorted(conditions) and sorted(quality.cascade_order(empty, conditions)) == sorted(conditions)


def test_language_model(docs, empty, texts):
    rows = {r.doc_id: r for r in lm_scoring.score_documents(docs, known=50).collect()}
    tokens = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t or "")), ""]
    counts = Counter(w for k, t in texts.items() if zlib.crc32(str(k).encode()) % 5 != 1 for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    for k, t in texts.items():
        own = tokens(t)
        assert rows[k].held_out == (zlib.crc32(str(k).encode()) % 5 == 1) and rows[k].n_tokens == len(own) and rows[k].train_tokens == n
        assert rows[k].n_known == sum(counts[w] > 0 for w in own)
        assert rows[k].base_score == pytest.approx(sum(np.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own))
        assert np.isfinite(rows[k].score) and rows[k].score < 0
    assert lm_scoring.score_documents(empty).count() == 0


def test_tokens_in_batches():
    import pyarrow as pa

    r = random.Random(2)
    texts = [None, "", " \n\t ", "A b\u00a0c\x1f \x0b d", "É\u2003x  "] + ["".join(r.choice(" \t\nABxyé\x1c\u0085") for _ in range(r.randint(0, 30))) for _ in range(300)]
    want = [[w.translate({i: i + 32 for i in range(65, 91)}) for w in WORD.findall(t or "")] + [""] for t in texts]
    words, starts = lm_scoring.tokens(pa.array(texts, pa.string()))
    assert [words[a:b].to_pylist() for a, b in zip(starts[:-1], starts[1:], strict=True)] == want
    words, starts = lm_scoring.tokens(pa.array(texts, pa.string()).slice(7, 100))
    assert [words[a:b].to_pylist() for a, b in zip(starts[:-1], starts[1:], strict=True)] == want[7:107]
    words, starts = lm_scoring.tokens(pa.array([], pa.string()))
    assert len(words) == 0 and starts.tolist() == [0]


def plain_score(net, doc):
    """Forward pass of one document, step by step, as the definition has it."""
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    k, h, total, before = net.hidden, np.zeros(net.hidden), 0.0, net.start
    u, w, v = (x.astype(float) for x in (net.u, net.w, net.v))
    for cell in doc:
        a = net.x[before].astype(float) + net.bias
        z, r = sigmoid(a[:k] + h @ u[:, :k]), sigmoid(a[k : 2 * k] + h @ u[:, k : 2 * k])
        h = (1 - z) * h + z * np.tanh(a[2 * k :] + (r * h) @ u[:, 2 * k :])
        outer, inner = np.exp(np.r_[h, 1] @ w), np.exp(np.r_[h, 1] @ v[cell // gru.WIDTH])
        total += np.log10(outer[cell // gru.WIDTH] / outer.sum() * inner[cell % gru.WIDTH] / inner.sum())
        before = cell
    return total


def test_scores_equal_a_plain_forward_pass():
    r = np.random.default_rng(8)
    net = gru.Network(3, 5)
    net.begin_with(np.r_[r.integers(0, 50, 150), np.full(42, -1)])
    net.w += r.normal(0, 0.5, net.w.shape).astype(np.float32)
    net.v[:, :-1] += r.normal(0, 0.5, net.v[:, :-1].shape).astype(np.float32)
    docs = [r.integers(0, 150, n).astype(np.int32) for n in (1, 40, 300, 7)]
    assert np.allclose(gru.score(net, docs, lanes=2), [plain_score(net, d) for d in docs], rtol=1e-4)
    assert sum(10 ** plain_score(net, [c]) for c in range(192)) == pytest.approx(1)  # probabilities of all cells


def test_scores_beat_a_bigram(spark):
    """Held out, the model beats the base, and on texts that copy no training text a bigram interpolated with the base, too."""
    rows = lm_scoring.op5_lm_scoring(spark, "/root/testdata/sf0.01").filter("held_out").collect()
    texts = {r.doc_id: [*r.text.lower().split(), ""] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("text is not null").collect()}
    held = {r.doc_id for r in rows}
    ones, pairs, fours = Counter(), Counter(), set()
    for k, t in texts.items():
        if k not in held:
            ones.update(t)
            pairs.update(zip(["<", *t[:-1]], t, strict=True))
            fours.update(zip(t, t[1:], t[2:], t[3:], strict=False))
    n, v, starts = sum(ones.values()), len(ones), Counter()
    for (a, _), c in pairs.items():
        starts[a] += c
    base = lambda w: (ones[w] + 0.5) / (n + 0.5 * (v + 1))
    two = lambda a, w: 0.5 * base(w) + 0.5 * (pairs[a, w] / starts[a] if starts[a] else base(w))
    known = lambda t: sum(x in fours for x in zip(t, t[1:], t[2:], t[3:], strict=False))
    fresh = [r for r in rows if 10 * known(texts[r.doc_id]) < len(texts[r.doc_id])]
    for own in (rows, fresh):
        total = sum(r.n_tokens for r in own)
        bigram = sum(np.log10(two(a, w)) for r in own for a, w in zip(["<", *texts[r.doc_id][:-1]], texts[r.doc_id], strict=True)) / total
        base_, model = sum(r.base_score for r in own) / total, sum(r.score for r in own) / total
        print(f"{len(own)} texts: base {base_:.3f}, bigram {bigram:.3f}, model {model:.3f}")
        assert model > base_ + 0.3 or own is fresh
    assert len(fresh) > 30 and model > bigram and model > base_


def test_network_gradients_and_order():
    r = np.random.default_rng(0)
    docs = [r.integers(1, 6, n).astype(np.int32) for n in (30, 5, 1, 17, 40, 3)]
    net = gru.Network(1, 4)
    one = np.array([gru.score(net, [d])[0] for d in docs])
    assert np.allclose(gru.score(net, docs, lanes=2), one, atol=1e-4)  # lanes change nothing; states carry through whole documents
    cycle = [np.array([1, 2, 3, 4, 5] * 8, np.int32) for _ in range(200)]
    before = gru.score(net, cycle).sum()
    state = None
    for _ in range(6):
        state = gru.train(net, cycle, steps=8, lanes=16, state=state)
    assert gru.score(net, cycle).sum() > 0.3 * before


def test_language_model_has_all_its_cells(spark):
    rows = spark.createDataFrame([(f"{a}{b}{c}{d}", 1) for a in "abcdefgh" for b in "stuvwxyz" for c in "klmnopqrst" for d in "abcdefghijkl"], "word string, n long")
    cells = lm_scoring.choose_cells(rows, 500, 300, 20)
    assert (len(cells.own), len(cells.endings), len(cells.number), cells.classes) == (500 + 1, 300, 821, 13)  # and the end token
    assert sorted(cells.number.values()) == list(range(821)) and {cells.of(w) for w in cells.own} | {cells.of("x" + e) for e in cells.endings} <= set(range(821))
    import pyarrow as pa

    words = [*cells.own[:50], "", "é", "日本語!", "...", "\"|", "xé日a)", "ab", *(f"{a}{b}" for a in ("q", "éé", "stk") for b in (*cells.endings[:40], "zz.", ""))]
    assert cells.numbers(pa.array(words)).tolist() == [cells.of(w) for w in words] and len(cells.numbers(pa.array([], pa.string()))) == 0


@pytest.mark.parametrize("lengths", [[200] * 20, [5000], [3000] + [20] * 50, [1], [7, 1, 1]])
def test_training_covers_all_tokens(lengths):
    r = np.random.default_rng(3)
    docs = [r.integers(1, 4, n).astype(np.int32) for n in lengths]
    docs[0][-max(1, lengths[0] // 3) :] = 70  # the end of the longest text
    net = gru.Network(2, 4)
    before = net.x[70].copy()
    state = gru.train(net, docs)
    assert lengths[0] == 1 or (net.x[70] != before).all()  # a cell that no learned input shows would stay
    assert state["tokens"] == sum(lengths)
    assert gru.train(net, docs, state=state)["tokens"] == 2 * sum(lengths)


def test_pieces_begin_with_the_state_before_them():
    r = np.random.default_rng(4)
    net, doc = gru.Network(1, 4), r.integers(1, 6, 400).astype(np.int32)
    states, h = [np.zeros((1, 4), np.float32)], np.zeros((1, 4), np.float32)
    for x in np.r_[net.start, doc[:-1]]:
        h = net.step(h, np.array([x]))[-1]
        states.append(h)
    for size in (16, 64, 96):
        cuts = [(0, a) for a in range(0, 400, size)]
        assert np.allclose(gru.first_states(net, [doc], cuts, size), np.concatenate([states[a] for _, a in cuts]), atol=1e-2 if size > 16 else 0.3)


def test_gradient_by_differences():
    r = np.random.default_rng(1)
    docs = [r.choice([1, 2, 3, 70, 71], 8).astype(np.int32) for _ in range(8)]
    net = gru.Network(2, 3)
    net.v += r.normal(0, 0.3, net.v.shape).astype(np.float32)
    flat, loss = net.flat(), lambda f: -gru.score(gru.Network.of(f, 2, 3), docs).sum() * np.log(10) / 64
    moved = gru.Network.of(flat, 2, 3)
    gru.train(moved, docs, steps=8, lanes=8, rate=1e-3)
    step = np.sign(moved.flat() - flat)
    slopes = np.array([(loss(flat + 1e-2 * e) - loss(flat - 1e-2 * e)) / 2e-2 for e in np.eye(len(flat))])
    clear = np.abs(slopes) > 1e-3
    assert clear.sum() > 20 and (np.sign(slopes[clear]) == -step[clear]).mean() > 0.97


KEY = "quillspan test key"


def py_feistel(left, right, a, b, kind):
    f = lambda i, x: int(hashlib.sha256(f"{KEY}|{kind}|{i}|{x}".encode()).hexdigest()[:12], 16)
    for i in range(pii.ROUNDS):
        left, right = ((left + f(i, right)) % a, right) if i % 2 == 0 else (left, (right + f(i, left)) % b)
    return left, right


def luhn(d):
    return sum((x if i % 2 == 0 else x * 2 - 9 * (x > 4)) for i, x in enumerate(map(int, reversed(d)))) % 10


def py_digits(d, kind):
    h = len(d) // 2
    x, y = py_feistel(int(d[:h]), int(d[h:]), 10**h, 10 ** (len(d) - h), kind)
    return str(x).zfill(h) + str(y).zfill(len(d) - h)


def test_pseudonyms(spark, docs, empty):
    text = "a.b@c.example.com 10.0.0.255 10.0.0.256 123-45-6789 666-45-6789 2024-02-29 2023/02/29 +1 (974) 555-3436 974.555.3436 4417744280351547 4417-7442-8035-1547 4417744280351548 token = \"04dbebab91ab8568\" x04dbebab91ab8568"
    rows = spark.createDataFrame([(1, text, 5), (2, None, 5), (3, "", 5), (4, text, 5), (5, "9" * 3000 + " 12.5 1-2-3", 5)], "doc_id long, text string, keep long")
    got = {r.doc_id: r for r in pii.pseudonymise(rows, KEY).collect()}
    out = got[1].text.split(" ")
    assert (got[1].n_email, got[1].n_ip, got[1].n_ssn, got[1].n_date, got[1].n_phone, got[1].n_card, got[1].n_secret) == (1, 1, 1, 1, 2, 2, 1)
    assert out[0].endswith("@pii.invalid") and out[2] == "10.0.0.256" and out[4] == "666-45-6789" and out[6] == "2023/02/29" and out[13] == "4417744280351548"
    x, y = py_feistel(10 * 256, 255, 65536, 65536, "ip")
    assert out[1] == f"{x // 256}.{x % 256}.{y // 256}.{y % 256}"
    x, y = py_feistel(974 - 200, (555 - 200) * 10000 + 3436, 800, 8_000_000, "phone")
    ten = f"{x + 200}{y // 10000 + 200}{y % 10000:04d}"
    assert " ".join(out[7:10]) == f"+1 ({ten[:3]}) {ten[3:6]}-{ten[6:]}"
    assert f"{ten[:3]}.{ten[3:6]}.{ten[6:]}" in got[1].text
    card = py_digits("441774428035154", "card")
    card += next(str(c) for c in range(10) if luhn(card + str(c)) == 0)
    assert card in got[1].text and "-".join(card[i : i + 4] for i in range(0, 16, 4)) in got[1].text
    x, y = py_feistel(122, 44 * 9999 + 6788, 898, 989901, "ssn")
    assert f"{x + (1 if x < 665 else 2):03d}-{y // 9999 + 1:02d}-{y % 9999 + 1:04d}" in got[1].text
    assert "04dbebab91ab8568 x" not in got[1].text and "x04dbebab91ab8568" in got[1].text
    assert got[2].text is None and got[3].text == "" and got[4].text == got[1].text and got[5].text == "9" * 3000 + " 12.5 1-2-3" and got[1].keep == 5
    assert pii.pseudonymise(empty).count() == 0
    other = pii.pseudonymise(rows, key="another").filter("doc_id = 1").first().text
    assert other != got[1].text
    first, again = (pii.pseudonymise(rows).filter("doc_id = 1").first().text for _ in range(2))
    assert first == again and first not in (other, got[1].text)  # the session's own key


def test_phones_keep_their_form_and_stay_apart(spark):
    phones = [f"{a:03d}-{x:03d}-{n:04d}" for a in (0, 199, 200, 999) for x in (5, 199, 200, 987) for n in (0, 1, 9999)]
    rows = spark.createDataFrame(list(enumerate(phones)), "doc_id long, text string")
    got = [r.text for r in pii.pseudonymise(rows, KEY).orderBy("doc_id").collect()]
    assert len(set(got)) == len(phones) and all(re.fullmatch(r"\d{3}-\d{3}-\d{4}", g) for g in got)
    assert [(g[0] >= "2", g[4] >= "2") for g in got] == [(p[0] >= "2", p[4] >= "2") for p in phones]


def test_secrets_of_letters_alone(spark):
    rows = spark.createDataFrame([(1, 'api token = "abcdefabcdefabcdef" end'), (2, "KEY:\"ABCDEFABCDEFABCDEFAB\""), (3, 'token = "abcdef"')], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.pseudonymise(rows, KEY).collect()}
    assert [got[i].n_secret for i in (1, 2, 3)] == [1, 1, 0] and "abcdefabcdef" not in got[1].text and "ABCDEF" not in got[2].text and got[3].text == 'token = "abcdef"'


def test_clashing_columns(spark):
    names = ["doc_id", "text", "n_email", "_matches", "_found", "words", "fp", "_kept", "_place", "x", "n_chars", "spans", "key"]
    rows = spark.createDataFrame([(i, "card 4417744280351547 " + "a b c d e " * i, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1) for i in range(5)], names).withColumn("n_chars", F.col("n_chars").cast("int"))
    benchmark = spark.createDataFrame([(1, "nothing like it", 2)], "item_id long, text string, fp long")
    for out in (pii.pseudonymise(rows, counts=False), simhash.drop_near_duplicates(rows), quality.filter_documents(rows), decontamination.remove_passages(rows, benchmark)):
        assert out.schema.names == names and out.count() <= 5 and dict(out.dtypes)["n_chars"] == "int"
    assert pii.pseudonymise(rows).filter("n_email = 0 and n_card = 1").count() == 5
    path = token_counts.model_path("word_bpe_49k.json")
    for out in (packing.pack(rows, path), sharding.shard_rows(rows), quality.measure(rows), decontamination.report(rows, benchmark), substring_dedup.remove_repeats(rows), lm_scoring.score_documents(rows), simhash.near_duplicates(rows), token_counts.count_tokens(rows, token_counts.model_path("piece_bpe_32k.model"))):
        assert out.count() == 5
    assert chat.format_chats(rows.selectExpr("doc_id as conv_id", "1 as turn", "'user' as role", "text", "x as part", "x as k")).count() == 5


def test_secrets_in_either_case(spark):
    value = "9233a8ecf7c5b09fe5949719b6b82bc439e9329b"
    rows = spark.createDataFrame([(1, f'TOKEN = "{value.upper()}"'), (2, f'token = "{value}"'), (3, f'Key:"{value.upper()}"'), (4, '"PASSWORD" "1234567890ABCDEF"')], "doc_id long, text string")
    found = {r.doc_id: r for r in pii.pseudonymise(rows).collect()}
    new = found[2].text[9:-1]
    assert len(new) == 40 and new != value and [found[i].n_secret for i in (1, 2, 3, 4)] == [1, 1, 1, 0]
    assert (found[1].text, found[3].text, found[4].text) == (f'TOKEN = "{new}"', f'Key:"{new}"', '"PASSWORD" "1234567890ABCDEF"')


def test_pseudonyms_are_one_to_one(spark):
    rows = spark.range(3000).selectExpr("id as doc_id", "concat('1.2.', id div 256, '.', id % 256, ' ', date_add(date'1950-01-01', cast(id as int))) as text")
    found = [r.text.split(" ") for r in pii.pseudonymise(rows).collect()]
    assert len({a for a, _ in found}) == 3000 and len({b for _, b in found}) == 3000 and all(re.fullmatch(r"\d{4}-\d\d-\d\d", b) for _, b in found)


def test_decontamination(spark, docs, empty, texts):
    items = {1: texts[8], 2: None, 3: "Hello world", 4: texts[20][:200], 5: "  "}
    benchmark = spark.createDataFrame(list(items.items()), "item_id long, text string")
    want = decontamination.brute_force(texts, items)
    for block in (1 << 20, 30):
        got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontamination.report(docs, benchmark, block).collect()}
        assert got == want
    none = decontamination.report(docs, benchmark.limit(0))
    assert none.filter("contaminated").count() == 0 and none.count() == len(texts)
    assert decontamination.report(empty, benchmark).count() == 0
    clean = decontamination.remove_passages(docs, benchmark)
    assert clean.columns == docs.columns and not decontamination.report(clean, benchmark).filter("contaminated").count()
    by_id = {r.doc_id: r for r in clean.collect()}
    assert by_id[22].text == texts[22] and by_id[1].text is None and by_id[4].text == "." and by_id[9].n_chars == len(by_id[9].text)


def test_fm_index():
    r = np.random.default_rng(2)
    for _ in range(20):
        words = r.integers(0, 5, r.integers(1, 200))
        index = fm_index.FMIndex(words)
        patterns = r.integers(1, 6, (20, 3))
        low, high = index.search(patterns)
        for p, a, b in zip(patterns, low, high, strict=True):
            want = [i for i in range(len(words) - 2) if (words[i : i + 3] == p).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def removed(texts, length):
    seen, out = set(), {}
    for k in sorted(texts):
        b = (texts[k] or "").encode()
        mark = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            if w in seen:
                mark[p : p + length] = b"\1" * length
            seen.add(w)
        kept = bytes(x for x, m in zip(b, mark, strict=True) if not m)
        out[k] = (len(b), len(b) - len(kept), sum(bool(m) and (i == 0 or not mark[i - 1]) for i, m in enumerate(mark)), hashlib.sha256(kept).hexdigest())
    return out


def test_substring_dedup(spark, docs, empty, texts):
    for shard in (1 << 20, 500):
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in substring_dedup.remove_repeats(docs, shard=shard).collect()}
        assert got == removed(texts, 100)
    assert got[8][1] == 0 and got[40][1] == got[40][0] and got[6][1] == 4999
    assert substring_dedup.remove_repeats(empty).count() == 0
    twice = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(docs.filter("doc_id = 22").unionAll(docs.filter("doc_id = 22"))).collect()}
    assert twice == {22: 0}


@pytest.mark.parametrize("bounds", [{}, {"shard": 3000}, {"shard": 3000, "contexts_": 2, "rows_": 3}, {"shard": 400, "rows_": 2}])
def test_hot_phrase_and_near_copies(spark, bounds):
    """A phrase in a third of the texts, each time between other bytes, and a third of near copies; with bounds, the groups are dealt again and spread."""
    r = random.Random(3)
    say = lambda n, of="abcdefgh ": "".join(r.choice(of) for _ in range(n))
    phrase, passage, texts = say(95), say(500), {}
    for i in range(450):
        near = list(passage)
        near[r.randrange(500)] = r.choice("xyz")
        texts[i] = (say(r.randint(0, 80)) + phrase + say(r.randint(0, 60), "ab"), "".join(near), say(r.randint(0, 300)))[i % 3]
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in substring_dedup.remove_repeats(df, **bounds).collect()}
    assert got == removed(texts, 100)


def test_workers_hold_a_shard_of_a_hot_group():
    """One key of 40,000 different contexts: no shard is larger than its bound, and what is left is dealt again."""
    import pyarrow as pa

    r, sizes = np.random.default_rng(0), []

    class Watched(substring_dedup.Shards):
        def solve(self, rows, onward):
            sizes.append(sum(map(len, rows["bytes"].to_pylist())))
            return super().solve(rows, onward)

    common = bytes(r.integers(97, 123, 70))
    rows = [(7, 0, i, 0, 30, 5, 0, 33, bytes(r.integers(97, 123, 30)) + common + bytes(r.integers(97, 123, 32))) for i in range(40_000)]
    batches = (substring_dedup._batch(rows[i : i + 5000], substring_dedup._DEALT) for i in range(0, len(rows), 5000))
    out = pa.Table.from_batches(list(Watched(100, 1 << 19).run(batches)))
    assert len(sizes) > 8 and max(sizes) <= 1 << 19
    assert out.filter(pa.compute.is_valid(out["bytes"])).num_rows == 40_000  # all differ, so all meet again under narrower keys


def test_documents_without_an_id_keep_their_own_bytes(spark):
    r = random.Random(11)
    a, b = ("".join(r.choice("abcdef") for _ in range(300)) for _ in range(2))
    rows = [(None, a), (None, b), (None, a), (3, a), (4, b + "x"), (None, None), (5, None)]
    got = sorted((x.doc_id or 0, x.n_bytes, x.n_removed) for x in substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted([(0, 300, 0)] * 3 + [(0, 0, 0), (3, 300, 300), (4, 301, 300), (5, 0, 0)])


def test_substrings_at_random(spark):
    r = random.Random(9)
    parts = ["".join(r.choice("ab") for _ in range(r.randint(30, 160))) for _ in range(25)]
    texts = {i: "".join(r.choice(parts) for _ in range(r.randint(0, 8))) for i in range(60)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in substring_dedup.remove_repeats(df).collect()}
    assert got == removed(texts, 100)


def test_bounded_expansion():
    r = random.Random(6)
    for _ in range(20):
        text = bytes(r.choice([97, 98, 255]) if r.random() < 0.9 else 99 for _ in range(r.randint(1, 300))) + b"\xff"
        least = r.choice([1, 2, 5, 9])
        order, boundary = bwt_lcp.long_prefix_rows(np.frombuffer(text, np.uint8), least)
        for i in range(1, len(order)):
            x, y = text[order[i - 1] : order[i - 1] + least], text[order[i] : order[i] + least]
            if len(x) == len(y) == least and 255 not in x + y:
                assert (x != y) == boundary[i]


def test_packing(spark, docs, empty, texts):
    from tokenizers import Tokenizer

    path = token_counts.model_path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    want = {k: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for k, t in texts.items()}
    rows = packing.pack(docs, path, capacity=256).collect()
    bins, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        part = want[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
        bins[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.piece, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 256
    for k, own in pieces.items():
        assert [p for p, _ in sorted(own)] == list(range(len(own))) and all(n == 256 for _, n in sorted(own)[:-1]) and sum(n for _, n in own) == len(want[k])
    assert set(pieces) == set(texts) and len(bins) <= -(-sum(map(len, want.values())) // 256) + 3
    assert packing.pack(empty, path).count() == 0


def test_word_encoder():
    path = token_counts.model_path("word_bpe_49k.json")
    texts = ["", "  ", "áb ́c", "İ. foo İstanbul", "<|endoftext|>x y<|startoftext|>", "Ça. l'été, don't. 12.5, x\u001cq", "ﬁ. é. é. a.b, ., ..", "Σ ΑΣ, ǅ ß. ª º"]
    for cached in (3, 1000):
        encoder = packing.WordEncoder(path, cached)
        for _ in range(2):
            assert encoder.encode(texts) == [np.array(e.ids, "<u4").tobytes() for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("lengths", [[], [5] * 1000 + [4096] * 3, [2000] * 7 + [2096] * 3, "wide", "middle"])
def test_packing_plan(lengths):
    r = random.Random(8)
    lengths = {"wide": [r.randint(1, 4096) for _ in range(3000)], "middle": [r.randint(400, 1000) for _ in range(3000)]}.get(lengths if isinstance(lengths, str) else "", lengths)
    runs, n = packing_plan.plan(dict(Counter(lengths)), 4096)
    used, placed = defaultdict(list), Counter()
    for x in runs:
        placed[x.length] += x.copies * x.each
        for c in range(x.copies):
            used[x.sequence + c].append((x.offset, x.length * x.each))
    assert placed == Counter(lengths) and len(used) == n
    for own in used.values():
        at = 0
        for offset, size in sorted(own):
            assert offset == at
            at += size
        assert at <= 4096
    assert n <= -(-sum(lengths) // 4096) * 1.06 + 1
    with pytest.raises(ValueError):
        packing_plan.plan({5000: 1}, 4096)


def test_passages_go_whatever_the_blocks(spark, docs, texts):
    items = [(1, " ".join(WORD.findall(texts[8])[5:40])), (2, " ".join(WORD.findall(texts[9])[20:45])), (3, None), (None, " ".join(WORD.findall(texts[21])[:12]))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = docs.unionAll(docs.filter("doc_id in (8, 9)"))
    one, many = (sorted((r.doc_id, r.text or "", r.n_chars) for r in decontamination.remove_passages(rows, benchmark, n).collect()) for n in (1 << 20, 20))
    assert one == many and len(one) == len(texts) + 2
    assert decontamination.remove_passages(rows, benchmark, 20).columns == docs.columns
    left = {k: t for k, t, _ in one}
    assert not any(v[-1] for v in decontamination.brute_force({k: left[k] for k in (8, 9, 21)}, dict(items)).values()) and left[5] == texts[5]


def test_cascade_puts_cheap_rejection_first(docs):
    slow = "exists(transform(sequence(1, 1000), i -> sha2(concat(text, i), 256)), h -> h = '')"
    order = quality.cascade_order(docs, {"slow_none": slow, "slow_some": f"not ({slow}) and text > 'm'", "cheap_some": "text > 'm'", "cheap_none": "text = 'no such'"})
    assert order[0] == "cheap_some" and order[-1] == "slow_none" and order.index("slow_some") < order.index("cheap_none")


def test_a_rejected_edge_of_a_bucket_does_not_cut_off_a_similar_text(spark, monkeypatch):
    rng = random.Random(11)
    base = [f"w{i}" for i in range(400)]

    def edit(words, n):
        out = list(words)
        for i in rng.sample(range(len(out)), n):
            out[i] = f"x{rng.random()}"
        return out

    # pairs of close texts, each pair some 0.7 to 0.8 from the others, so that candidates of one bucket are often not similar
    texts = [" ".join(edit(own, 4)) for own in (edit(base, 9) for _ in range(30)) for _ in range(2)]
    rows = [(i, t) for i, t in enumerate(texts)]
    sets = [set(simhash.shingle_hashes(t, 5, 42).tolist()) for t in texts]
    prints = np.array([simhash.wide_fingerprint(t) for t in texts]).T
    columns = [np.arange(len(texts)), np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), np.arange(len(texts)), *prints[: simhash.CHECKED].view(np.int64)]
    found = {(min(u, v), max(u, v)) for b in simhash._edges_of(columns, simhash.CHECKED_BITS, True) for u, v in zip(*(c.to_pylist() for c in b.columns), strict=True)}
    far = lambda i, j: int(np.bitwise_count(prints[: simhash.CHECKED, i] ^ prints[: simhash.CHECKED, j]).sum())
    assert found == {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if far(i, j) <= simhash.CHECKED_BITS}
    similar = [(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    assert similar and len(similar) < len(texts) * (len(texts) - 1) // 4
    monkeypatch.setattr(simhash, "block_keys", lambda *a: [F.lit(1).cast("long")])  # all in one bucket
    group = {r.doc_id: r.group for r in simhash.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(group[i] == group[j] for i, j in similar)


def test_small_graphs_are_joined_by_one_task(spark, monkeypatch):
    """Rounds of small queries fill the driver: a graph within ONE_TASK takes two tables, a larger one goes by rounds, and both say the same."""
    r = random.Random(3)
    low = -(2**62)
    path = [(low + i, low + i + 1) for i in range(300)]
    edges = path + [(r.randrange(400), r.randrange(400)) for _ in range(250)] + [(5, 5), (None, 1), (2, None), (7, 6), (6, 7)]
    rows = spark.createDataFrame(edges, "u long, v long").repartition(5).cache()
    names = []
    monkeypatch.setattr(components, "materialise", lambda df, name, f=components.materialise: names.append(name) or f(df, name))
    one = {x.node: x.root for x in components.components(rows).collect()}
    assert names == ["edges", "stars"]
    assert all(one[low + i] == low for i in range(1, 301))
    forest = components.Forest(400)
    for u, v in edges[300:]:
        if u is not None and v is not None:
            forest.join(u, v)
    assert {k: v for k, v in one.items() if k >= 0} == {k: forest.find(k) for k in range(400) if forest.find(k) != k}
    monkeypatch.setattr(components, "ONE_TASK", 0)
    assert {x.node: x.root for x in components.components(rows).collect()} == one and len(names) > 4
    rows.unpersist()


def test_a_crowded_bucket_gives_members_and_loses_no_pair(spark):
    """Many texts that are apart but near: pairs by a part of the fingerprints don't become rows, and none that is close by all words is lost."""
    rng = np.random.default_rng(8)
    base = rng.integers(0, 2, 1024)
    prints = np.array([np.packbits(base ^ (rng.random(1024) < 0.1), bitorder="little").view("<u8") for _ in range(120)]).T
    columns = [np.arange(120), np.full(120, 7), np.zeros(120, np.int64), np.arange(120), *prints[: simhash.CHECKED].view(np.int64)]
    far = lambda a, b, n: int(np.bitwise_count(prints[:n, a] ^ prints[:n, b]).sum())
    want = {(a, b): far(a, b, 16) for a in range(120) for b in range(a + 1, 120) if far(a, b, simhash.CHECKED) <= simhash.CHECKED_BITS and far(a, b, 16) <= simhash.WIDE_BITS}
    rows = [x for batch in simhash._pairs_or_members(columns, simhash.CHECKED_BITS) for x in batch.to_pylist()]
    assert len(want) > 120 >= len(rows) and all(x["v"] is None and x["key"] == 7 for x in rows)
    frame = spark.createDataFrame([(i, i, *(int(x) for x in prints[:, i].view(np.int64))) for i in range(120)], "rep long, group long, " + ", ".join(f"w{i} long" for i in range(16)))
    found, measured = simhash.all_links(frame, F.array(F.lit(7).cast("long")), 1)
    got = {(x.u, x.v): x.far for x in measured.collect()}
    assert found.count() == 0 and want.items() <= got.items() and all(far(*k, 16) == v <= simhash.WIDE_BITS for k, v in got.items())
