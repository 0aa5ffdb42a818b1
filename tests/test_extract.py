import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quillspan.operators import embed, formal, relate, segment, worldview
from quillspan.plans.extract import FILES, Extraction
from quillspan.session import materialise
from quillspan.sources import config as C
from quillspan.sources import documents as D
from quillspan.sources.config import Config


def run(spark, *texts, **config):
    return Extraction(D.from_texts(spark, list(texts)), Config(**config))


def index(x):
    return x.index.orderBy("document_id", "pos").collect()


A = "Knowledge concerns truth. Justice should harmonize the soul. If virtue is knowledge, teaching matters."


def test_three_sentences_give_three_ranked_claims(spark):
    x = run(spark, A)
    assert x.fragments.count() == 3
    assert x.ingested.first().run_id == "run_cda1068555eeb435"
    assert [(r.id, r.claim_kind, r.domain, r.confidence, r.role, r.philosophical_score, r.specificity_score, r.source_quality_score, r.final_rank_score) for r in index(x)] == [
        ("p_1860ada08e5bcb674fe4166f", "conditional", "epistemology", 0.75, "conclusion", 1.0, 0.9, 1.0, 0.8),
        ("p_65b836623958858c763fd97b", "normative", "ethics", 0.68, "main_claim", 1.0, 0.65, 1.0, 0.75),
        ("p_c325f23547fa528025d131af", "atomic", "epistemology", 0.62, "premise", 0.86, 0.45, 0.8, 0.62),
    ]
    assert x.clusters.count() == 3 and x.arguments.count() == 0 and x.relations.count() == 0


def test_opposite_claims_contradict_and_stay(spark):
    x = run(spark, "The soul is immortal. The soul is not immortal.")
    assert [(r.id, r.final_rank_score, r.relation_score) for r in index(x)] == [("p_15a8bd74bdb1dfa8143713bc", 0.73, 0.5), ("p_7f1a35df4e7e13d7c24feb12", 0.66, 0.5)]
    kinds = {(r.kind, r.from_id[:6], r.to_id[:6]) for r in x.relations.collect()}
    assert kinds == {("contradicts", "p_15a8", "p_7f1a"), ("supports", "p_7f1a", "p_15a8")}
    assert not x.diagnostics.filter("code = 'fingerprint_duplicate_merged'").count()


def test_merging_and_variants(spark):
    x = run(spark, "Truth is knowable. truth is knowable.", "Truth is knowable. The truth is knowable.", "Knowledge concerns truth and reason. Knowledge concerns truth and reason itself.")
    by_doc = {}
    for r in index(x):
        by_doc.setdefault(r.document_id, []).append(r)
    sizes = sorted((len(v), len(v[0].fragment_ids)) for v in by_doc.values())
    assert sizes == [(1, 2), (1, 2), (2, 1)]
    codes = [r.code for r in x.diagnostics.collect()]
    assert codes.count("fingerprint_duplicate_merged") == 1 and codes.count("semantic_variant_detected") == 1
    assert [round(r.confidence, 2) for r in x.relations.filter("kind = 'variant_of'").collect()] == [0.8]


def test_rank_and_limit(spark):
    x = run(spark, "The meeting is scheduled. Truth is knowable.", max_propositions=1)
    assert [r.canonical_text for r in index(x)] == ["Truth is knowable."]
    y = run(spark, "Reality is intelligible. Knowledge concerns truth. Justice should guide action.", max_propositions=2)
    assert len(index(y)) == 2
    assert run(spark, A, include_relations=False).relations.count() == 0


def test_offsets_slice_the_text(spark):
    text = "Dr. Smith wrote pi is 3.14. Wait... Really? Yes!"
    other = "Aristotle argues in Phys. III that change is actuality. Knowledge concerns truth."
    x = run(spark, text, other, "Äpfel sind rund genug. 😀 ist ein Zeichen hier. Das ist “gut.” Und es geht weiter.")
    texts = {r.document_id: r.text for r in x.ingested.collect()}
    found = x.passages.collect()
    assert all(texts[p.document_id].encode()[p.start_byte : p.end_byte].decode() == p.text for p in found)
    assert sum(p.text.startswith(("Aristotle", "Knowledge")) for p in found) == 2


def test_paragraphs_without_ingestion(spark):
    docs = D.from_texts(spark, [{"id": "d", "text": "One two three. Four five six.\n\nSeven eight nine."}]).withColumnRenamed("id", "document_id")
    assert [(r.paragraph_index, r.locator) for r in segment.passages(docs).orderBy("sequence").collect()] == [(0, "paragraph 1, sentence 1"), (0, "paragraph 1, sentence 2"), (1, "paragraph 2, sentence 1")]


def test_ingestion(spark):
    docs = D.from_texts(spark, ["  a\r\n\r\n b \rc  ", " \n ", {"text": None}, {"id": " x ", "kind": "", "text": "t"}])
    got = {r.text: (r.kind, r.document_id) for r in segment.ingest(docs).collect()}
    assert got["a\n b\nc"][0] == "philosophical_text" and got["t"][1] == "x" and len(got) == 2
    assert segment.empty_inputs(docs).count() == 2


def test_stage_gate_and_summaries(spark):
    x = run(spark, A, stage_through="segment")
    assert [(r.name, r.output_count) for r in x.summaries().orderBy("place").collect()] == [("ingest", 1), ("segment", 3)]
    assert set(x.response()) == {"stages"}
    assert run(spark, A).summaries().count() == 13


def test_artifacts(spark, tmp_path):
    refs = run(spark, A).write(str(tmp_path / "all"))
    assert len(refs) == 13 and sorted(p.name for p in (tmp_path / "all").iterdir()) == sorted([*FILES.values(), "manifest.json"])
    assert len(run(spark, A, stage_through="segment").write(str(tmp_path / "some"))) == 2
    assert not (tmp_path / "some" / "manifest.json").exists()
    row = json.loads(next((tmp_path / "all" / FILES["ingest"]).glob("part*")).read_text().splitlines()[0])
    assert row["stage"] == "ingest" and row["run_id"] == "run_cda1068555eeb435"


def test_worldview(spark):
    value = json.loads(run(spark, A).worldviews().first().worldview)
    assert value["schemaVersion"] == "10" and len(value["propositions"]) == 3 and value["id"].startswith("draft-worldview-")
    first = value["propositions"][0]
    assert first["assertions"][0]["id"] == "assertion_" + first["id"] and [f["family"] for f in first["facets"]] == ["claim_kind", "philosophical_domain"]
    assert first["metadata"]["finalRankScore"] == 0.8


def test_relation_ids(spark):
    long = "p_" + "x" * 80
    rows = spark.createDataFrame([("d", "a", "b", "supports", None), ("d", long, long, "supports", None)], "document_id string, from_id string, to_id string, kind string, note string")
    ids = [r.id for r in worldview.relation_rows(rows).orderBy("id").collect()]
    assert "relation_a_supports_b" in ids and all(len(i) <= 120 for i in ids)


def test_terms_and_unknown_model(spark):
    x = run(spark, "Knowledge concerns truth. Knowledge matters.", term_extraction_backend="text-linguistics")
    terms = {r.normalized_label: r for r in x.terms.collect()}
    assert terms["knowledge"].term_type == "concept" and len(terms["knowledge"].passage_ids) == x.passages.count()
    assert "truth" in terms and x.diagnostics.filter("code = 'ner_provider_unavailable'").count() == 1


def test_lean():
    atom = {"kind": "atomic"}
    assert formal.lean({"kind": "not", "value": atom}) == "Not (True)"
    assert formal.lean({"kind": "and", "values": [atom, atom]}) == "True /\\ True"
    assert formal.lean({"kind": "implies", "left": atom, "right": {"kind": "iff", "left": atom, "right": atom}}) == "(True) -> (Iff (True) (True))"
    assert formal.lean({"kind": "for_all", "variable": "x", "body": {"kind": "or", "values": [atom, atom]}}) == "forall x : Prop, True \\/ True"


def test_config(monkeypatch):
    monkeypatch.setenv("QUILLSPAN_LEAN_BIN", "/bin/lean")
    c = C.from_json({"minConfidence": 0.5, "nlpMode": "local_models", "stageThrough": "extract-claims", "other": 1})
    assert (c.min_confidence, c.nlp_mode, c.stage_through, c.auto_download_models, c.lean_bin) == (0.5, "local-models", "extract_claims", True, "/bin/lean")
    args, d = C.from_arguments(["in.txt", "--max-propositions", "3", "--no-include-relations", "--pretty"])
    assert args.input == "in.txt" and args.pretty and d.max_propositions == 3 and not d.include_relations
    with pytest.raises(ValueError):
        C.checked({"embedding_backend": "nothing"})


def test_request_bodies(spark):
    bodies = ['{"document": {"text": "A b c.", "title": "T"}}', '{"text": "Only text."}', "Raw text here."]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    assert {(r.text, r.title) for r in D.from_bodies(df).collect()} == {("A b c.", "T"), ("Only text.", None), ("Raw text here.", None)}
    assert D.handle("/health", "GET", "")[1] == {"status": "ok"} and D.handle("/x", "GET", "")[0] == 404
    assert D.body_config('{"config": {"maxPropositions": 2}}').max_propositions == 2 and D.body_config("raw").max_propositions is None


def test_empty_table(spark):
    x = Extraction(D.from_texts(spark, []))
    assert x.index.count() == 0 and x.worldviews().count() == 0


def test_reranking(spark):
    x = run(spark, "The soul is immortal. The soul is not immortal.", embedding_backend="text-retrieval")
    rows = x.relations.filter("kind = 'contradicts'").collect()
    assert len(rows) == 1 and rows[0].confidence >= 0.72 and "text-retrieval-hybrid" in rows[0].metadata


def test_reranking_embeds_only_documents_with_relations(spark, monkeypatch):
    x = run(spark, "The soul is immortal. The soul is not immortal. Virtue is knowledge.", "Justice should harmonize the soul. Knowledge concerns truth.")
    asked, whole = [], embed.hash_embedding
    monkeypatch.setattr(embed, "hash_embedding", lambda rows, *a, **k: asked.append(rows) or whole(rows, *a, **k))
    rows = relate.reranked(x.propositions, relate.relations(x.propositions)).collect()
    assert len(rows) == 1 and "semanticScore" in rows[0].metadata
    assert {r.canonical_text for r in asked[0].collect()} == {"The soul is immortal.", "The soul is not immortal.", "Virtue is knowledge."}


def test_tokens_are_hashed_once_for_all_dimensions(spark):
    df = embed.hash_embedding(spark.createDataFrame([("A word, a word.",)], "text string"), 128)
    lines = [s for s in str(df._jdf.queryExecution().optimizedPlan().toString()).splitlines() if "sha2(" in s]
    assert lines and not any("as float" in s for s in lines)


def test_export_leaves_only_what_worldviews_read(spark):
    texts = [A, "The soul is immortal. The soul is not immortal."]
    whole, x = run(spark, *texts), run(spark, *texts)
    expected = sorted(map(tuple, whole.worldviews().collect()))
    folder = Path(whole._written[0][1].removeprefix("file://")).parent
    before = set(folder.iterdir())
    assert sorted(map(tuple, x.export().collect())) == expected
    assert sorted(p.name.rsplit("-", 1)[0] for p in set(folder.iterdir()) - before) == ["index", "passages", "relations"]
    assert x.propositions.count() == whole.propositions.count()  # made anew


def test_written_tables_leave_no_shuffle_files(spark):
    def shuffled():
        folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for d in folders for f in Path(d).rglob("shuffle_*.data")}

    before = shuffled()
    df = materialise(spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count(), "cleaned")
    for _ in range(50):  # they go in the background
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before and df.count() == 7


def test_streaming_equals_batch(spark, tmp_path):
    from quillspan.streaming.claims import stream_claims, write_claims

    D.from_texts(spark, [{"id": "a", "text": A}]).write.parquet(str(tmp_path / "in"))
    query = write_claims(spark.readStream.schema(D.SCHEMA).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination(120)
    batch = stream_claims(spark.read.schema(D.SCHEMA).parquet(str(tmp_path / "in")))
    assert {r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {r.id for r in batch.collect()} and batch.count() == 3


def test_command_line(spark, tmp_path):
    from quillspan.__main__ import extract

    (tmp_path / "in.txt").write_text(A)
    out = json.loads(extract(spark, [str(tmp_path / "in.txt"), "--artifact-dir", str(tmp_path / "artifacts"), "--output", str(tmp_path / "out.json"), "--title", "T"]))
    assert out["runId"] == "run_cda1068555eeb435" and len(out["candidates"]) == 3 and out["worldview"]["label"] == "T" and len(out["artifacts"]) == 13
    assert json.loads((tmp_path / "out.json").read_text()) == out
    part = json.loads(extract(spark, [str(tmp_path / "in.txt"), "--stage-through", "segment", "--no-persist-artifacts"]))
    assert part["candidates"] == [] and [s["name"] for s in part["stages"]] == ["ingest", "segment"]


def test_texts_may_hold_the_marks_of_segmentation(spark):
    """Offsets, cuts and texts with private-use characters in them; the sentences are given by hand."""
    from quillspan.operators import segment

    marks = "\ue000\ue001\ue002\ue003\ue004"
    parts = [f"Alpha beta{marks}gamma stays one.", f"Dr. {marks[1]}{marks[4]} Smith is here!", f"{marks[::-1]} ends\ue001\ue003 so."]
    text = " ".join(parts)
    docs = spark.createDataFrame([("d", text)], "document_id string, text string")
    rows = segment.sentences(docs).orderBy("pos").collect()
    assert [r.text for r in rows] == parts
    assert all(text.encode()[r.start_byte : r.end_byte].decode() == r.text for r in rows)
