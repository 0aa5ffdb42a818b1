import copy
import hashlib
import json

import pytest

from quillspan.operators import evidence, spans
from quillspan.operators.spans import InvalidBatch
from quillspan.plans.extract import extract_spans
from quillspan.sources import corpus


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


TEXT = "Méditation 𝄞\n\nI think, therefore I am — cogito 😀 ergo sum.\n\nDoubt is the beginning of wisdom."


def batch(text=TEXT, ranges=((0, 12), (14, 58), (60, 93)), media=False):
    header = {"schema": "corpus_core_batch", "schema_version": 1, "producer": {"name": "search", "revision": "git:1"}}
    source = {"id": "source:1", "kind": "inline", "uri": "a.txt", "metadata": {"title": "T", "video_id": "v1"}}
    asset = {"id": "asset:1", "source_id": "source:1", "kind": "video" if media else "text", "content": {"uri": "a.txt", "hash": sha(text), "media_type": None, "byte_length": None}, "metadata": {}}
    provenance = {"operation": "x", "producer": "p", "producer_version": "git:2", "inputs": [{"record_type": "asset", "id": "asset:1"}], "parameters_hash": None}
    rep = {"id": "rep:1", "owner": {"record_type": "asset", "id": "asset:1"}, "kind": "transcript" if media else "extracted_text", "content_hash": sha(text), "content": None, "provenance": provenance, "metadata": {}}
    segments = []
    for i, (a, b) in enumerate(ranges):
        locator = {"byte_range": None, "character_range": {"start": a, "end": b}, "page_index": None, "time_range_ms": {"start": 1000 * i, "end": 1000 * i + 500} if media else None, "frame_range": None, "selectors": {"character_unit": "unicode_scalar", "representation_id": "rep:1"}}
        inputs = [{"record_type": "representation", "id": "rep:1"}]
        segments.append({"id": f"segment:{i}", "asset_id": "asset:1", "locator": locator, "provenance": provenance | {"inputs": inputs}, "metadata": {"heading_path": '["H", null]', "paragraph_ordinal": str(i), "source_selector": "p"}})
    records = [("source", source), ("asset", asset), ("representation", rep), *(("segment", s) for s in segments)]
    return [header, *({"record": {"record_type": k, "record": r}} for k, r in records), {"payload": {"hash": sha(text), "media_type": "text/plain", "text": text}}]


def read(spark, lines):
    return corpus.read_batch(corpus.lines_of(spark, "\n".join(json.dumps(x, ensure_ascii=False) if not isinstance(x, str) else x for x in lines)))


def test_spans(spark):
    got = read(spark, batch())
    rows = got.spans.orderBy("sequence").collect()
    assert [(r.text, r.byte_start, r.byte_end, r.paragraph_ordinal, r.heading_path) for r in rows] == [
        ("Méditation 𝄞", 0, 16, 0, ["H"]), ("I think, therefore I am — cogito 😀 ergo sum.", 18, 67, 1, ["H"]), ("Doubt is the beginning of wisdom.", 69, 102, 2, ["H"]),
    ]
    assert all(TEXT.encode()[r.byte_start : r.byte_end].decode() == r.text for r in rows)
    source = got.sources.first()
    assert source.revision == "sha256:" + sha(TEXT) and source.title == "T"
    segment = batch()[4]["record"]["record"]
    want = "sha256:" + sha(json.dumps(segment, sort_keys=True, separators=(",", ":"), ensure_ascii=False))
    assert json.loads(rows[0].metadata)["corpusCoreSegmentRevision"] == want


def test_order_of_lines_does_not_matter(spark):
    lines = batch()
    a, b = read(spark, lines), read(spark, [lines[0], *reversed(lines[1:])])
    assert a.spans.orderBy("id").collect() == b.spans.orderBy("id").collect()


def test_timed_spans_and_media(spark):
    got = read(spark, batch(media=True))
    rows = got.spans.orderBy("sequence").collect()
    assert [(r.locator_kind, r.start_seconds, r.end_seconds, r.segment_index) for r in rows] == [("timed", 0.0, 0.5, 0), ("timed", 1.0, 1.5, 1), ("timed", 2.0, 2.5, 2)]
    one = lambda rows, schema: spark.createDataFrame(rows, schema)
    media = {
        "evidence": one([("v1", 0, "sha256:0")], "video_id string, pos int, revision string"),
        "scenes": one([("v1", "s", 0, 0.0, 1.2, "p", "1", "m", "1")], "video_id string, id string, scene_index long, start_seconds double, end_seconds double, processor string, processor_version string, model string, model_version string"),
        "tracks": one([("v1", "t", "title", "x", 2.1, None, "p", "1", "m", "1")], "video_id string, id string, role string, text string, start_seconds double, end_seconds double, processor string, processor_version string, model string, model_version string"),
        "sponsor_segments": one([("v1", "u", "ad", "skip", 1.4, 9.0)], "video_id string, id string, category string, action_type string, start_seconds double, end_seconds double"),
    }
    contexts = {r.span_id: (len(r.scenes or []), len(r.ocr or []), len(r.sponsors or [])) for r in spans.media_context(got.spans, *(media[k] for k in ("evidence", "scenes", "tracks", "sponsor_segments"))).collect()}
    assert contexts == {"segment:0": (1, 0, 0), "segment:1": (1, 0, 1), "segment:2": (0, 1, 1)}
    candidates, _ = extract_spans(got, media=media)
    found = candidates.collect()
    assert {r.source_segments[0].start_seconds for r in found} == {1.0, 2.0} and all(r.media_context for r in found)


def change(path, value):
    def apply(lines):
        lines = copy.deepcopy(lines)
        at = lines
        for p in path[:-1]:
            at = at[p]
        at[path[-1]] = value
        return lines

    return apply


FAULTS = {
    "are not read here": change((0, "schema_version"), 2), "a name and a revision": change((0, "producer", "revision"), " "), "no source": change((2, "record", "record", "source_id"), "x"), "no asset": change((4, "record", "record", "asset_id"), "x"),
    "no representation": change((4, "record", "record", "locator", "selectors", "representation_id"), "x"), "no owner": change((3, "record", "record", "owner", "id"), "x"), "another hash": change((7, "payload", "text"), "other"), "bad hash": change((3, "record", "record", "content_hash"), "ABC"),
    "kind unknown": change((2, "record", "record", "kind"), "odd"), "metadata that are no strings": change((1, "record", "record", "metadata", "title"), 1), "record type unknown": change((1, "record", "record_type"), "thing"), "outside of representation": change((4, "record", "record", "locator", "character_range", "end"), 1000),
    "invalid character range": change((4, "record", "record", "locator", "character_range", "start"), 50), "twice the record": lambda x: [*x, x[1]], "no payload": lambda x: x[:-1], "neither record": lambda x: [*x, "{"], "header": lambda x: ["", "  "],
    "fields that nobody knows": change((1, "record", "record", "more"), 1), "but its content names": change((3, "record", "record", "content"), {"uri": "u", "hash": "0" * 64, "media_type": None, "byte_length": None}), "is no number": change((4, "record", "record", "metadata", "paragraph_ordinal"), "x"),
    "heading_path": change((4, "record", "record", "metadata", "heading_path"), "[1]"), "made from nothing known": change((3, "record", "record", "provenance", "inputs"), [{"record_type": "asset", "id": "y"}]), "counted in unicode_scalar": change((4, "record", "record", "locator", "selectors", "character_unit"), "byte"),
}


@pytest.mark.parametrize("message", FAULTS)
def test_faulty_batches_are_refused(spark, message):
    with pytest.raises(InvalidBatch, match=message):
        read(spark, FAULTS[message](batch()))


def test_evidence(spark):
    got = read(spark, batch())
    out = json.loads(evidence.export(got, "git:5"))
    assert [r["class"] for r in out["evidence"]].count("source_text") == 3 and len(out["evidence"]) == 4
    assert [r["id"] for r in out["evidence"]] == sorted(r["id"] for r in out["evidence"])
    compact = lambda x: json.dumps(x, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    for r in out["evidence"]:
        body = {k: v for k, v in r.items() if k != "id"}
        assert r["id"] == "evidence:source-span:sha256:" + sha(compact(body))
        s = r["source"]
        assert r["familyId"] == "family:source-record:sha256:" + sha(compact([s["repository"], s["scopeId"], s["recordId"]]))
    assert out["revision"] == "sha256:" + sha(compact(out["evidence"]))
    head = next(r for r in out["evidence"] if r["class"] == "metadata")
    assert all(r["parentEvidenceIds"] == [head["id"]] for r in out["evidence"] if r["class"] == "source_text")
    with pytest.raises(InvalidBatch, match="no fixed revision"):
        evidence.export(got, "main")
    with pytest.raises(InvalidBatch, match="timed|cannot be exported"):
        evidence.export(read(spark, batch(media=True)), "git:5")


def test_media_violations(spark):
    p = {c: "x" for c in spans.PROVENANCE}
    names = ", ".join(f"{c} string" for c in spans.PROVENANCE)
    good = "sha256:" + "0" * 64
    videos = spark.createDataFrame([("v", "u", good), ("", "u", "md5")], "id string, source_url string, revision string")
    scenes = spark.createDataFrame([("v", "s1", 0.0, 1.0, 0, 1, *p.values()), ("v", "s2", 2.0, 1.0, 5, 1, "", *list(p.values())[1:])], f"video_id string, id string, start_seconds double, end_seconds double, start_frame long, end_frame long, {names}")
    observations = spark.createDataFrame([("v", "o1", "t", 1.0, 0.5, 1, 1, *p.values()), ("v", "o2", " ", -1.0, 1.5, 0, 1, *p.values())], f"video_id string, id string, text string, timestamp_seconds double, confidence double, width long, height long, {names}")
    tracks = spark.createDataFrame([("v", "t1", "x", "r", 1, 0.0, 1.0, None, None, ["o1"], ["s1"], *p.values()), ("v", "t2", "x", "r", 0, 0.0, None, 3, 1, ["o9"], ["s9"], *p.values())], f"video_id string, id string, text string, role string, sample_count long, start_seconds double, end_seconds double, start_frame long, end_frame long, observation_ids array<string>, scene_ids array<string>, {names}")
    blocks = spark.createDataFrame([("b", "l", "a", good), ("c", "", "a", "x")], "snapshot_id string, data_license string, attribution string, response_hash string")
    segments = spark.createDataFrame([("u", "c", 0.0, 1.0, 9.0), ("w", "", 3.0, 1.0, float("nan"))], "id string, category string, start_seconds double, end_seconds double, video_duration double")
    found = spans.media_violations(videos, scenes, observations, tracks, blocks, segments)
    messages = " | ".join(r.message for r in found.collect())
    for part in ("source URL", "no full sha256", "scene s2: bad times", "scene s2: frames end", "run id", "o2: no text", "o2: bad time", "o2: bad confidence", "o2: region without", "t2: text, role or samples missing", "t2: frames end", "no observation o9", "no scene s9", "blocks need snapshot", "w: no category", "w: bad times", "w: bad duration"):
        assert part in messages, part
    assert "s1" not in messages and "o1" not in messages.replace("o1]", "") and "t1" not in messages
    with pytest.raises(InvalidBatch):
        spans.require(found)


def test_command_line_exports(spark, tmp_path):
    from quillspan.__main__ import export

    path = tmp_path / "batch.jsonl"
    path.write_text("\n".join(json.dumps(x) for x in batch()))
    assert json.loads(export(spark, [str(path), "--exporter-revision", "git:5"]))["exporter"]["revision"] == "git:5"
    assert len(json.loads(export(spark, [str(path), "--source-spans"]))["spans"]) == 3
