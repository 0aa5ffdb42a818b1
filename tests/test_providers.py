import pytest

from quillspan.operators import claims, embed, providers, terms
from quillspan.plans.extract import Extraction
from quillspan.sources import documents as D
from quillspan.sources.config import Config


def test_entities_are_merged_with_terms(spark):
    class Names(providers.NerProvider):
        name, model = "names", "test"

        def entities(self, texts):
            return [[("Plato", "plato", "person", 0.9)] if "Plato" in t else [] for t in texts]

    x = Extraction(D.from_texts(spark, ["Plato wrote on virtue. Virtue is knowledge."]), Config(nlp_mode="local-models"), ner=Names())
    found = {r.normalized_label: r for r in x.terms.collect()}
    assert (found["plato"].term_type, found["plato"].confidence, found["plato"].model_added) == ("person", 0.9, True)
    assert found["virtue"].term_type == "concept" and not found["virtue"].model_added
    assert providers.RuleNer().entities(["a"]) == [[]]
    assert terms.entity_terms(Names()(x.passages)).count() == 1


def test_pluggable_embeddings(spark):
    class Lengths(embed.EmbeddingProvider):
        name, model = "lengths", "test"

        def embed(self, texts):
            return [[float(len(t)), 1.0] for t in texts]

    rows = spark.createDataFrame([("abc",), ("",)], "text string")
    assert sorted(r.vector for r in embed.embed_with(Lengths(), rows).collect()) == [[0.0, 1.0], [3.0, 1.0]]


def test_classifier_equals_its_columns(spark):
    texts = ["If a then b", "It is so because of x", "For example this", "You should go", "All are one", "Nothing here", "x IS y"]
    c = providers.HeuristicClassifier()
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", claims.classified_kind("t").alias("k"), claims.classified_role("t").alias("r")).collect()
    assert all((r.k, r.r) == (c.claim_kind(r.t).label, c.role(r.t).label) for r in rows)
    assert c.relation("a is not b", "a is b").label == "contradicts" and c.relation("a", "b").label == "supports"


def test_labels(spark):
    rows = spark.createDataFrame([(" Main-Claim ",), ("mainclaim",), ("variant of",), ("Modal",), ("x",)], "t string")
    got = [tuple(r) for r in rows.select(claims.role_of_label("t"), claims.relation_of_label("t"), claims.kind_of_label("t")).collect()]
    assert got == [("main_claim", None, "unknown"), ("main_claim", None, "unknown"), ("unknown", "variant_of", "unknown"), ("unknown", None, "modal"), ("unknown", None, "unknown")]


def test_stand_ins(spark):
    with pytest.raises(providers.ProviderError):
        providers.UnconfiguredGeneration("m").generate_structured(providers.StructuredPrompt("i", "t", {}))
    source, note = providers.LeanSource().evaluate("formal_p-1", {"kind": "not", "value": {"kind": "atomic"}})
    assert "def formal_p_1 : Prop := Not (True)" in source and note["code"] == "lean_not_executed"
    rows = spark.createDataFrame([('{"a":true,"b":["x",1,"y"]}',), ('{"a":"true","b":3}',), ("?",)], "m string")
    got = [tuple(r) for r in rows.select(providers.metadata_flag("m", "a"), providers.metadata_strings("m", "b")).collect()]
    assert got == [(True, ["x", "y"]), (False, []), (False, [])]


def test_nearest_in_blocks(spark):
    """Against all pairs: ties, vectors of other lengths, zero, empty and missing ones, repeated queries' blocks."""
    import random

    import numpy as np

    from quillspan.operators import embed

    r = random.Random(6)
    rows = [(i, [float(r.choice([-1, 0, 1, 2])) for _ in range(4)]) for i in range(700)] + [(700, [1.0, 2.0]), (701, [0.0] * 4), (702, []), (703, None), (None, [1.0] * 4)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    asked = [x for x in rows if x[0] is not None and x[0] % 20 == 0 or x[0] in (701, 702)]

    def similarity(a, b):
        a, b = np.array(a), np.array(b)
        return round(float(a @ b / np.sqrt((a @ a) * (b @ b))), 6) + 0.0 if len(a) == len(b) and len(a) and a.any() and b.any() else 0.0

    own = {i: v for i, v in rows if i is not None and v is not None}
    want = {(q, n + 1, i) for q, v in asked for n, (_, i) in enumerate(sorted((-similarity(v, u), i) for i, u in own.items() if i != q)[:5])}
    queries = spark.createDataFrame(asked, "query_id long, query array<float>")
    for block in (embed.QUERY_BLOCK, 7):
        assert {(x.query_id, x.place, x.vec_id) for x in embed.nearest(queries, vectors, 5, block).collect()} == want
    assert embed.nearest(queries.limit(0), vectors, 5).count() == 0
