"""Corpus batches: JSON lines of sources, assets, representations, segments and payloads, checked and mapped to source spans.

Lines after the header may come in any order. Lines are read as a table, so a batch is checked and joined in parallel; every
check gives rows of violations, and the first of them (in order of checks) is raised.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import spans as V
from ..operators.spans import InvalidBatch, require, union, unknown, violations

SCHEMA, VERSION = "corpus_core_batch", 1
REFERENCE = "struct<record_type: string, id: string>"
RANGE = "struct<start: long, `end`: long>"
PROVENANCE = f"struct<operation: string, producer: string, producer_version: string, inputs: array<{REFERENCE}>, parameters_hash: string>"
CONTENT = "struct<uri: string, hash: string, media_type: string, byte_length: long>"
RECORDS = {
    "source": "id string, kind string, uri string, metadata map<string, string>",
    "asset": f"id string, source_id string, kind string, content {CONTENT}, metadata map<string, string>",
    "representation": f"id string, owner {REFERENCE}, kind string, content_hash string, content {CONTENT}, provenance {PROVENANCE}, metadata map<string, string>",
    "segment": f"id string, asset_id string, locator struct<byte_range: {RANGE}, character_range: {RANGE}, page_index: long, time_range_ms: {RANGE}, frame_range: {RANGE}, selectors: map<string, string>>, provenance {PROVENANCE}, metadata map<string, string>",
}
ASSET_KINDS = ["text", "web_page", "pdf", "image", "video", "audio", "subtitle", "document"]
TEXT_KINDS = ["extracted_text", "ocr_text", "transcript"]
MEDIA_KINDS = ["video", "audio", "subtitle"]
HEX = "^[0-9a-f]{64}$"


@dataclass
class SpanBatch:
    producer: dict
    sources: DataFrame
    spans: DataFrame


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumn("line", F.monotonically_increasing_id())


def lines_of(spark: SparkSession, text: str) -> DataFrame:
    return spark.createDataFrame([(i, x) for i, x in enumerate(text.split("\n"))] or [(0, "")], "line long, value string").select("value", "line")


def _fields(kind: str) -> list[str]:
    depth, out, word = 0, [], ""
    for c in RECORDS[kind] + ",":
        depth += (c == "<") - (c == ">")
        if c == "," and depth == 0:
            out.append(word.strip().split(" ")[0])
            word = ""
        else:
            word += c
    return out


def read_batch(lines: DataFrame, schema: str = SCHEMA) -> SpanBatch:
    """The source spans of a batch of lines (value, line); raises :class:`InvalidBatch`."""
    full = lines.filter(F.expr(f"not ({V.blank('value')})"))
    head = full.orderBy("line").limit(1).select(F.from_json("value", "schema string, schema_version int, producer struct<name: string, revision: string>").alias("h"), "line").collect()
    if not head:
        raise InvalidBatch("an empty batch has no header")
    header = head[0].h
    if header is None or header.schema is None or header.producer is None:
        raise InvalidBatch("the first line is no header")
    if (header.schema, header.schema_version) != (schema, VERSION):
        raise InvalidBatch(f"batches of {header.schema}@{header.schema_version} are not read here")
    producer = {"name": header.producer.name, "revision": header.producer.revision}
    if not all((v or "").strip() for v in producer.values()):
        raise InvalidBatch("the batch's producer needs a name and a revision")
    body = full.filter(F.col("line") > head[0].line).withColumn("v", F.expr("try_parse_json(value)")).withColumn("keys", F.json_object_keys("value"))
    body = body.withColumn("kind", F.expr("try_variant_get(v, '$.record.record_type', 'string')")).withColumn("record", F.expr("try_variant_get(v, '$.record.record', 'string')"))
    body = body.withColumn("record", F.get_json_object("value", "$.record.record")).withColumn("payload", F.get_json_object("value", "$.payload"))
    allowed = " ".join(f"when '{k}' then array({', '.join(repr(f) for f in _fields(k))})" for k in RECORDS)
    known = ", ".join(f"'{k}'" for k in RECORDS)
    shape = [
        ("line", "v is null or not (keys = array('record') or keys = array('payload'))", "concat('line ', line + 1, ': neither record nor payload')"),
        ("record_type", f"keys = array('record') and coalesce(kind, chr(0)) not in ({known})", "concat('line ', line + 1, ': record type unknown: ', coalesce(kind, 'none'))"),
        ("fields", f"kind in ({known}) and size(array_except(json_object_keys(record), case kind {allowed} end)) > 0", "concat('line ', line + 1, ': fields that nobody knows')"),
        ("payload", "keys = array('payload') and (size(array_except(json_object_keys(payload), array('hash', 'media_type', 'text'))) > 0 or get_json_object(payload, '$.text') is null or get_json_object(payload, '$.hash') is null)", "concat('line ', line + 1, ': no payload')"),
        ("metadata", "kind is not null and exists(map_values(coalesce(from_json(get_json_object(record, '$.metadata'), 'map<string,string>'), map())), x -> x is null)", "concat('line ', line + 1, ' has metadata that are no strings')"),
        ("metadata_type", "kind is not null and get_json_object(record, '$.metadata') rlike ':[ ]*(?:[0-9{\\\\[-]|true|false|null)(?=[^\\\"]*(?:\\\"[^\\\"]*\\\"[^\\\"]*)*$)'", "concat('line ', line + 1, ' has metadata that are no strings')"),
    ]
    require(union([violations(body, shape, "line")]))
    tables = {k: body.filter(F.col("kind") == k).select("line", F.from_json("record", RECORDS[k]).alias("r"), "record").select("line", "r.*", "record") for k in RECORDS}
    payloads = body.filter("payload is not null").select(F.get_json_object("payload", "$.hash").alias("hash"), F.get_json_object("payload", "$.text").alias("text"))
    sources, assets, representations, segments = (tables[k] for k in RECORDS)
    _check(sources, assets, representations, segments, payloads)
    return _map(producer, sources, assets, representations, segments, payloads)


def _check(sources: DataFrame, assets: DataFrame, representations: DataFrame, segments: DataFrame, payloads: DataFrame) -> None:
    bad = lambda col: f"{col} is not null and not {V.S.matches(col, HEX)}"
    every = [t.select("id", F.lit(k).alias("kind")) for k, t in zip(RECORDS, (sources, assets, representations, segments), strict=True)]
    all_ = every[0]
    for t in every[1:]:
        all_ = all_.unionByName(t)
    place = F.concat_ws("\u0001", "kind", "id")
    known = all_.select(place.alias("at"))
    inputs = representations.select("id", F.explode("provenance.inputs").alias("i")).unionByName(segments.select("id", F.explode("provenance.inputs").alias("i"))).withColumn("at", F.concat_ws("\u0001", "i.record_type", "i.id"))
    owners = representations.withColumn("at", F.concat_ws("\u0001", "owner.record_type", "owner.id"))
    empty = lambda what: [("id", V.blank("id"), f"'{what} identifier must not be empty'")]
    ranges = [(name, f"locator.{col} is not null and coalesce(locator.{col}.start > locator.{col}.`end` or locator.{col}.start < 0, true)", f"concat('segment ', id, ' has an invalid {name}')") for name, col in (("byte range", "byte_range"), ("character range", "character_range"), ("time range", "time_range_ms"), ("frame range", "frame_range"))]
    require(union([
        violations(payloads, [("payload_hash", f"not {V.S.matches('hash', HEX)}", "concat('payload with a bad hash ', hash)"), ("payload_text", "sha2(text, 256) <> hash", "concat('payload whose text has another hash than ', hash)")], "hash"),
        V.repeated(payloads, ["hash"], "payload_repeated", "concat('twice the payload ', hash)"),
        V.repeated(all_.select(F.col("id"), "kind"), ["id", "kind"], "record_repeated", "concat('twice the record ', id)"),
        violations(sources, empty("source")),
        violations(assets, [*empty("asset"), ("hash", bad("content.hash"), "concat('asset ', id, ': bad hash')"), ("kind", f"not (kind in ({', '.join(repr(k) for k in ASSET_KINDS)}) or kind like 'other:_%')", "concat('asset ', id, ': kind unknown: ', kind)")]),
        violations(representations, [
            *empty("representation"), ("hash", f"content_hash is null or {bad('content_hash')}", "concat('representation ', id, ': bad hash')"), ("content", bad("content.hash"), "concat('representation ', id, ': bad hash')"),
            ("conflict", "content.hash <> content_hash", "concat('representation ', id, ' content hash ', content_hash, ' but its content names ', content.hash)"), ("parameters", bad("provenance.parameters_hash"), "concat('representation ', id, ': bad hash')"),
        ]),
        violations(segments, [*empty("segment"), *ranges, ("parameters", bad("provenance.parameters_hash"), "concat('segment ', id, ': bad hash')")]),
        unknown(assets, "source_id", sources, "id", "asset_source", "concat('asset ', id, ': no source ', source_id)"),
        unknown(segments, "asset_id", assets, "id", "segment_asset", "concat('segment ', id, ': no asset ', asset_id)"),
        unknown(owners, "at", known, "at", "representation_owner", "concat('representation ', id, ': no owner ', owner.id)"),
        unknown(inputs, "at", known, "at", "provenance_input", "concat(id, ': made from nothing known: ', i.id)"),
    ]))


def revision(kind: str) -> F.Column:
    """SHA-256 of a record with all its fields, absent ones as null, keys sorted."""
    return F.concat(F.lit("sha256:"), F.sha2(F.expr(canonical(kind)), 256))


def canonical(kind: str) -> str:
    """SQL: the compact JSON of a typed record with sorted keys and explicit nulls."""
    typed = f"to_json(from_json(record, {RECORDS[kind]!r}), map('ignoreNullFields', 'false'))"
    return f"to_json(parse_json({typed}))"


def scalar_slice(text: str, start: str, end: str) -> tuple[str, str, str]:
    """SQL: (slice, byte start, byte end) for a range of Unicode scalars."""
    at = f"octet_length(substr({text}, 1, cast({start} as int)))"
    cut = f"substr({text}, cast({start} as int) + 1, cast({end} - {start} as int))"
    return cut, at, f"{at} + octet_length({cut})"


def heading_path(col: str) -> tuple[str, str]:
    """SQL: (the strings of a JSON array, whether it is anything else)."""
    values = f"try_variant_get(try_parse_json({col}), '$', 'array<variant>')"
    return f"coalesce(transform(filter({values}, x -> not is_variant_null(x)), x -> cast(x as string)), cast(array() as array<string>))", f"{col} is not null and ({values} is null or exists({values}, x -> schema_of_variant(x) not in ('STRING', 'VOID')))"


def _map(producer: dict, sources: DataFrame, assets: DataFrame, representations: DataFrame, segments: DataFrame, payloads: DataFrame) -> SpanBatch:
    selected = segments.withColumn("representation_id", F.expr("locator.selectors['representation_id']")).withColumn("unit", F.expr("locator.selectors['character_unit']"))
    reps = representations.select(F.col("id").alias("rep_id"), F.col("kind").alias("rep_kind"), "owner", "content_hash", F.col("provenance").alias("rep_provenance"), F.col("record").alias("rep_record"))
    joined = selected.join(reps, F.col("representation_id") == F.col("rep_id"), "left")
    texts = ", ".join(repr(k) for k in TEXT_KINDS)
    path, bad_path = heading_path("metadata['heading_path']")
    number = lambda c: f"metadata['{c}'] is not null and not {V.S.matches(c and 'metadata[' + repr(c) + ']', '^[+]?[0-9]{1,18}$')}"
    require(union([
        violations(joined, [
            ("range", "locator.character_range is null", "concat('segment ', id, ': no characters given, so no text span')"), ("unit", "coalesce(unit, '') <> 'unicode_scalar'", "concat('segment ', id, ': characters must be counted in unicode_scalar')"),
            ("representation", "representation_id is null", "concat('segment ', id, ': no representation named for its characters')"), ("unknown", "representation_id is not null and rep_id is null", "concat('segment ', id, ': no representation ', representation_id)"),
            ("owner", "rep_id is not null and not (owner.record_type = 'asset' and owner.id = asset_id)", "concat('segment ', id, ': counts in representation ', rep_id, ', which does not belong to asset ', asset_id)"),
            ("text_kind", f"rep_kind not in ({texts})", "concat('segment ', id, ': counts in representation ', rep_id, ', which holds no text')"),
        ]),
        joined.groupBy("asset_id").agg(F.count_distinct("rep_id").alias("n"), F.min("id").alias("id")).filter("n > 1").select(F.lit(0).alias("check_order"), F.lit("representations").alias("code"), F.col("asset_id").alias("target_id"), F.expr("concat('asset ', asset_id, ' has segments over more than one representation (segment ', id, ')')").alias("message")),
        unknown(joined.filter("rep_id is not null"), "content_hash", payloads, "hash", "payload_missing", "concat('representation ', rep_id, ' text is not carried in the batch (no payload for ', content_hash, ')')"),
        violations(joined, [("paragraph", number("paragraph_ordinal"), "concat('segment ', id, ': paragraph_ordinal is no number')"), ("index", number("segment_index"), "concat('segment ', id, ': segment_index is no number')"), ("headings", bad_path, "concat('segment ', id, ': heading_path is no list of strings')")]),
    ]))
    full = joined.join(payloads.select(F.col("hash").alias("content_hash"), F.col("text").alias("whole")), "content_hash").join(assets.select(F.col("id").alias("asset_id"), F.col("line").alias("asset_line"), F.col("kind").alias("asset_kind"), "source_id", F.col("content").alias("asset_content"), F.col("metadata").alias("asset_metadata")), "asset_id")
    full = full.join(sources.select(F.col("id").alias("source_id"), F.col("metadata").alias("source_metadata")), "source_id").withColumn("first", F.col("locator.character_range.start")).withColumn("last", F.expr("locator.character_range.`end`"))
    require(union([violations(full, [("bounds", "last > char_length(whole) or first >= last", "concat('segment ', id, ' character range ', first, '..', last, ' lies outside of representation ', rep_id, ' or empty')")])]))
    order = Window.partitionBy("asset_id").orderBy("first", "last", "id")
    cut, byte_start, byte_end = scalar_slice("whole", "first", "last")
    full = full.withColumn("sequence", F.row_number().over(order) - 1).withColumn("text", F.expr(cut)).withColumn("b0", F.expr(byte_start)).withColumn("b1", F.expr(byte_end))
    full = full.withColumn("timed", F.expr(f"locator.time_range_ms is not null or asset_kind in ({', '.join(repr(k) for k in MEDIA_KINDS)}) or rep_kind = 'transcript'"))
    inputs = F.col("provenance.inputs")
    meta = F.struct(
        F.when(F.col("timed"), F.col("b1")).alias("byteEnd"), F.when(F.col("timed"), F.col("b0")).alias("byteStart"), F.col("last").alias("characterEnd"), F.col("first").alias("characterStart"), revision("segment").alias("corpusCoreSegmentRevision"), F.col("locator.page_index").alias("pageIndex"),
        F.col("provenance.parameters_hash").alias("spanConfigHash"), F.col("provenance.producer").alias("spanProducer"), inputs.alias("spanProducerInputs"), F.col("provenance.producer_version").alias("spanProducerVersion"), F.when(F.col("timed"), F.expr("source_metadata['video_id']")).alias("videoId"),
    )
    text_only = lambda x: F.when(~F.col("timed"), x)
    spans = full.select(
        "id", F.col("asset_id").alias("source_id"), F.col("sequence").cast("long").alias("sequence"), "text", F.concat(F.lit("sha256:"), F.sha2("text", 256)).alias("content_hash"), F.expr("metadata['language']").alias("language"), F.expr("if(timed, 'timed', 'text')").alias("locator_kind"),
        text_only(F.col("b0").cast("long")).alias("byte_start"), text_only(F.col("b1").cast("long")).alias("byte_end"), text_only(F.expr("cast(metadata['paragraph_ordinal'] as bigint)")).alias("paragraph_ordinal"), F.lit(None).cast("long").alias("page"), F.lit(None).cast("string").alias("section"),
        text_only(F.expr("metadata['source_selector']")).alias("source_selector"), text_only(F.expr(path)).alias("heading_path"), F.when(F.col("timed"), F.expr("coalesce(cast(metadata['segment_index'] as bigint), sequence)")).alias("segment_index"),
        F.expr("if(timed, locator.time_range_ms.start / 1000D, null)").alias("start_seconds"), F.expr("if(timed, locator.time_range_ms.`end` / 1000D, null)").alias("end_seconds"), F.to_json(meta).alias("metadata"),
    )
    heads = full.groupBy("asset_id").agg(*(F.first(c).alias(c) for c in ("asset_line", "asset_kind", "source_id", "asset_content", "asset_metadata", "source_metadata", "rep_id", "content_hash", "rep_provenance", "rep_record")))
    source_meta = F.struct(
        F.concat(F.lit("sha256:"), "asset_content.hash").alias("assetContentHash"), F.col("rep_id").alias("corpusCoreRepresentationId"), F.concat(F.lit("sha256:"), F.sha2(F.expr(canonical("representation").replace("(record,", "(rep_record,")), 256)).alias("corpusCoreRepresentationRevision"), F.col("source_id").alias("corpusCoreSourceId"),
        F.col("rep_provenance.parameters_hash").alias("extractionConfigHash"), F.col("rep_provenance.producer").alias("extractionProducer"), F.col("rep_provenance.inputs").alias("extractionProducerInputs"), F.col("rep_provenance.producer_version").alias("extractionProducerVersion"),
    )
    revised = F.concat(F.lit("sha256:"), "content_hash")
    out = heads.select(F.col("asset_id").alias("id"), F.col("asset_kind").alias("kind"), revised.alias("revision"), F.col("asset_content.uri").alias("uri"), F.expr("source_metadata['title']").alias("title"), F.array().cast("array<string>").alias("creators"), F.expr("asset_metadata['language']").alias("language"), revised.alias("content_hash"), F.to_json(source_meta).alias("metadata"), F.col("asset_line").alias("pos"))
    require(V.span_violations(out, spans))
    return SpanBatch(producer, out, spans)
