"""The registered queries over a whole table, compared with plain definitions of their results."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from test_ops import WORD, removed

from quillspan.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def run(spark, name, columns):
    """The query's rows, once its first columns have been seen to be as agreed."""
    out = QUERIES[name](spark, SMALL)
    assert dict(out.dtypes).items() >= columns.items()
    return out.select(*columns).collect()


def test_op1_pieces_and_places(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    rows = run(spark, "op1_packing", {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"})
    got = {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows}
    want = {}
    for k, t in texts.items():
        ids = [*model.encode(t, add_special_tokens=False).ids, 1]
        for i in range(0, len(ids), 4096):
            own = np.array(ids[i : i + 4096], "<u4")
            want[k, i // 4096] = (i, len(own), zlib.crc32(own.tobytes()))
    assert got == want and len(rows) == len(got)
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for own in held.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(r.length for r in rows)
    assert len(held) <= 1.02 * -(-total // 4096) + 1


def test_op2_fingerprints_and_components(spark, texts):
    import xxhash

    lower = {i: i + 32 for i in range(65, 91)}

    def fingerprint(t):
        w = WORD.findall(t.translate(lower))
        hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))] if w else []
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0

    prints = {k: fingerprint(t) for k, t in texts.items()}
    component = {}
    for k in sorted(prints):
        if k in component:
            continue
        front, component[k] = [k], k
        while front:
            x = front.pop()
            for y in prints:
                if y not in component and (prints[x] ^ prints[y]).bit_count() <= 4:
                    component[y] = k
                    front.append(y)
    rows = run(spark, "op2_simhash", {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"})
    assert sorted(tuple(r) for r in rows) == sorted((k, f"{prints[k]:016x}", component[k]) for k in texts)


def test_op7_hits(spark, texts):
    fold = lambda t: bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in (t or "").encode()).split()
    windows = defaultdict(set)
    for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect():
        w = fold(r.text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i : i + 10])].add(str(r.item_id))
    want = []
    for k, t in texts.items():
        w, hit, items = fold(t), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if found := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    items |= found
        want.append((k, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    rows = run(spark, "op7_decontamination", {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"})
    assert sorted(tuple(r) for r in rows) == sorted(want) and any(x[-1] for x in want)


def test_op8_removed_bytes(spark, texts):
    rows = run(spark, "op8_substring_dedup", {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"})
    assert {r.doc_id: tuple(r)[1:] for r in rows} == removed(texts, 100) and len(rows) == len(texts)


def test_op9_balance(spark, texts):
    rows = run(spark, "op9_sharding", {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"})
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {k: (len(t.encode()) + 1, zlib.crc32(t.encode())) for k, t in texts.items()}
    assert {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert sorted(slots) == list(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_op10_counts(spark, texts):
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))
    rows = run(spark, "op10_token_counts", {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"})
    assert sorted(tuple(r) for r in rows) == sorted((k, len(t.encode()), n := len(model.encode(t)), n > 4096) for k, t in texts.items())
