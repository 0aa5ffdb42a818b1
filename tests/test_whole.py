"""Worldviews made a document at a time are those that the operators make together."""

import numpy as np
import pytest

from quillspan.operators import whole
from quillspan.plans.extract import Extraction
from quillspan.plans.queries import QUERIES
from quillspan.sources import documents as D
from quillspan.sources.config import Config

SENTENCES = [
    "Knowledge concerns truth and reason.", "Knowledge concerns truth and reason itself.", "knowledge concerns truth and reason.", "All men seek knowledge of truth and reason.", "If men seek knowledge, truth and reason follow.",
    "Knowledge does not concern truth and reason.", "Virtue is defined as knowledge of the good.", "Justice should guide the state and the law.", "Who what when knowledge concerns truth and reason!", "Maybe the meeting was published.",
    "Is this a question?", "Please write it down.", "Yes!", "No one knows the good.", "The good is possible for each citizen.", "Ärger über Öl schadet der Seele nie.", "A ß Ω б 😀 x² is here now.", "It is \"quoted\" \\ and\tkept\x1fhere\x0b now.",
]
ODD = [
    " ".join(SENTENCES), "\n".join(SENTENCES[::-1]), "\r\n\r\n - * One two three.\r* - four   five six seven.  Dr. Smith wrote of 3.14. éDr. Who is ́Dr. No. Émile xDr. Yes.", "HEADING OF A BOOK WITH WORDS. NEXT ÄÖ ONE HERE OK. ΑΒΓ ΔΕΖ ΗΘΙ ΚΛΜ.",
    " one two three.  four five six!  seven eight nine.", "?!. ... ! -", "- ", " \n ", "!!! one. - - -* two three four", "ab\x1ccd ef gh.\x85ij kl mn.　op qr st uv.", "literal \\u001f and \x01\x7f\b\f here.", "Truth is knowable. truth is knowable. Truth is knowable.", ". Ⅷ ⓐ ͅ x ٣ is good. नमस्ते दुनिया यह है. 中文 句子 在这里 is. ǅ ʰ ª words here.",
]


def rows(df):
    return sorted(map(tuple, df.select("document_id", "worldview_id", "worldview").collect()))


def odd(spark):
    texts = [{"id": f" d{i} ", "text": t, "title": 'A "title"' if i % 2 else None, "authors": [None, "B\x1f"] if i % 3 else [], "kind": "", "uri": "u\\", "language": None} for i, t in enumerate(ODD)]
    return D.from_texts(spark, [*texts, {"text": SENTENCES[0]}, {"id": "null"}])


def test_whole_documents_equal_the_operators(spark):
    docs = odd(spark)
    expected = rows(Extraction(docs).worldviews())
    assert len(expected) > 10 and rows(Extraction(docs).whole()) == expected


@pytest.mark.parametrize("config", [{"max_propositions": 4, "min_confidence": 0.66, "label": "L", "worldview_id": "w"}, {"include_relations": False}, {"embedding_backend": "text-retrieval", "classification_backend": "text-linguistics"}], ids=str)
def test_whole_documents_follow_the_configuration(spark, config):
    docs = D.from_texts(spark, [{"id": "a", "text": ODD[0]}, {"id": "b", "text": ODD[11]}])
    assert rows(Extraction(docs, Config(**config)).whole()) == rows(Extraction(docs, Config(**config)).worldviews())


def test_worldviews_move_texts_only(spark):
    """Before, every stage's table was moved and written: 20 times the input on disk."""
    plan = QUERIES["worldview_json"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan and "Window" not in plan


def test_rows_with_one_id_stay_apart(spark):
    docs = D.from_texts(spark, [{"id": "d", "text": SENTENCES[0]}, {"id": "d", "text": SENTENCES[6]}])
    alone = [rows(Extraction(D.from_texts(spark, [{"id": "d", "text": SENTENCES[i]}])).whole())[0] for i in (0, 6)]
    assert rows(Extraction(docs).whole()) == sorted(alone)


@pytest.mark.parametrize("n, cells", [(1, 1 << 20), (12, 7), (120, 500), (120, 1 << 20)])
def test_near_pairs_equal_brute_force(monkeypatch, n, cells):
    monkeypatch.setattr(whole, "CELLS", cells)
    draw = np.random.default_rng(n)
    sets = [sorted({b"%d" % (x * x // 90) for x in draw.integers(0, 90, draw.integers(0, 14))}) for _ in range(n)]
    found = list(zip(*(x.tolist() for x in whole.near(sets, 0.28))))
    jaccard = {(i, j): len(set(sets[i]) & set(sets[j])) / len(set(sets[i]) | set(sets[j])) for i in range(n) for j in range(i + 1, n) if sets[i] or sets[j]}
    assert sorted(found) == sorted((i, j, s) for (i, j), s in jaccard.items() if s >= 0.28)


def test_connected_passages_of_large_documents():
    draw = np.random.default_rng(7)
    buckets = [bytes(draw.integers(0, 16, 3).tolist()) for _ in range(600)]
    own = whole.vectors(buckets, 16, True)
    parts = [whole.connected(own[:500]), whole.connected(own)]
    for n, found in zip((500, 600), parts):
        v = own[:n].astype(float)
        near, group = v @ v.T / np.outer(*[np.sqrt((v * v).sum(1))] * 2) >= 0.58, np.arange(n)
        for _ in range(n):
            lower = np.where(near, group[None, :], n).min(axis=1)
            if (lower == group).all():
                break
            group = lower
        assert sorted(g.tolist() for g in found) == sorted(np.flatnonzero(group == k).tolist() for k in np.unique(group) if (group == k).sum() > 1)
