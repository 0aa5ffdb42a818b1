"""The registered queries as DuckDB SQL, from the same rules and word lists."""

from __future__ import annotations

from ..functions import rules as R
from ..functions.text import DUCK as D
from ..operators.segment import CUT, GUARD, cut_pattern, guard_pattern

DOCUMENTS = "docs as (select cast(doc_id as varchar) as id, text from documents)"
CHATS = "docs as (select cast(conv_id as varchar) as id, string_agg(text, chr(10) order by turn, text) as text from conversations group by conv_id)"


def _pieces(text: str) -> str:
    guarded = D.replace(text, guard_pattern(), f"\\1.{GUARD}\\2")
    return D.map(D.split(D.replace(guarded, cut_pattern(), f"\\1{CUT}\\2"), CUT), "p", f"replace(p, '{GUARD}', '')")


def _breaks(x: str) -> str:
    return f"(len(string_split_regex({x}, '\\n[ \\t]*\\n')) - 1)"


class Steps:
    """Named steps over ``docs``; :meth:`sql` puts those that a query needs in front of it."""

    def __init__(self, base: str):
        digits = "(select range from range(0, 16))"
        unit = "cast(c as float) / cast(sqrt(cast(n as double)) as float)"
        self.steps = {
            "docs": base.removeprefix("docs as (")[:-1],
            "ing": f"select id as document_id, t as text, sha256(t) as raw_text_hash, 'run_' || substr(sha256(coalesce(raw, '')), 1, 16) as run_id from (select id, text as raw, {D.ingest('text')} as t from docs) where t <> ''",
            "cut": f"select document_id, unnest(ps) as piece, generate_subscripts(ps, 1) - 1 as pos from (select document_id, {_pieces('text')} as ps from ing)",
            "cut2": f"select document_id, pos, piece, {D.trim('piece')} as text, {D.left_trim('piece')} as stripped, {_breaks('piece')} as breaks from cut",
            "cut3": f"select *, strlen(piece) - strlen(stripped) as lead, {_breaks('left(piece, length(piece) - length(stripped))')} as lead_breaks, coalesce(sum(strlen(piece)) over w, 0) as base, coalesce(sum(breaks) over w, 0) as before from cut2 window w as (partition by document_id order by pos rows between unbounded preceding and 1 preceding)",
            "sent": f"select document_id, pos, cast(before + lead_breaks as bigint) as paragraph_index, cast(base + lead as bigint) as start_byte, cast(base + lead + strlen(text) as bigint) as end_byte, text, {D.words('text')} as n_words from cut3 where text <> ''",
            "grp": "select *, row_number() over p as sentence, coalesce(sum(n_words) over (partition by document_id, paragraph_index order by pos rows between unbounded preceding and 1 preceding), 0) as held from sent window p as (partition by document_id, paragraph_index order by pos)",
            "grp2": "select *, sum(case when sentence = 1 or (n_words >= 3 and held >= 3) then 1 else 0 end) over (partition by document_id order by pos) as sequence from grp",
            "pass": "select 'frag_' || document_id || '_' || sequence as id, document_id, min(paragraph_index) as paragraph_index, cast(sequence as bigint) as sequence, 'paragraph ' || (min(paragraph_index) + 1) || ', sentence ' || arg_min(sentence, pos) as locator, min(start_byte) as start_byte, max(end_byte) as end_byte, string_agg(text, ' ' order by pos) as text from grp2 group by document_id, sequence",
            "can": f"select document_id, sequence as pos, id as fragment_id, {D.canonical('text')} as bare from pass",
            "can2": f"select document_id, pos, fragment_id, {D.canonical_done('bare')} as canonical_text from can",
            "can3": f"select *, {D.lower('canonical_text')} as lower, {D.words('canonical_text')} as n_words from can2 where canonical_text <> ''",
            "can4": f"select *, {D.claim_kind('lower')} as claim_kind, {D.negated('lower')} as negated, {D.domain('lower')} as domain, 'p_' || substr(sha256(canonical_text), 1, 24) as id from can3 where n_words >= 3 and not {D.is_question('canonical_text', 'lower')} and not {D.is_instruction('lower')}",
            "cand": f"select *, {D.confidence('canonical_text', 'lower', 'n_words', 'claim_kind')} as confidence from can4",
            "role": "select document_id, pos, id as claim_id, case when claim_kind = 'definition' then 'definition' when claim_kind = 'conditional' then case when last then 'conclusion' else 'premise' end when claim_kind = 'normative' then 'main_claim' when last and n > 1 then 'conclusion' else 'premise' end as primary_role from (select *, row_number() over (partition by document_id order by pos desc) = 1 as last, count(*) over (partition by document_id) as n from cand)",
            "rolelast": "select document_id, claim_id, arg_max(primary_role, pos) as role from role group by document_id, claim_id",
            "tok": f"select *, {D.tokens('canonical_text', R.CONTENT_STOPWORDS)} as content_tokens, {D.tokens('canonical_text', R.RELATION_STOPWORDS)} as relation_tokens from cand where confidence >= 0.35",
            "fp": f"select *, {D.fingerprint('content_tokens')} as fingerprint from tok",
            "first": "select *, row_number() over g as nth, first_value(id) over g as kept, first_value(canonical_text) over g as kept_text from fp window g as (partition by document_id, fingerprint, claim_kind, negated order by pos)",
            "mrg": "select document_id, fingerprint, claim_kind, negated, arg_min(id, pos) as id, arg_min(canonical_text, pos) as canonical_text, arg_min(domain, pos) as domain, arg_min(content_tokens, pos) as content_tokens, arg_min(relation_tokens, pos) as relation_tokens, max(confidence) as confidence, list(fragment_id order by pos) as fragment_ids, coalesce(list_sort(list_distinct(list(id order by pos) filter (where nth > 1))), []) as duplicate_ids from first group by document_id, fingerprint, claim_kind, negated",
            "prop": "select * exclude (domain), domain, row_number() over (partition by document_id order by fragment_ids[1], id) as pos from mrg",
            "emb": f"select document_id, id, sequence, paragraph_index, unnest(coalesce(nullif({D.map(D.filter(D.split(D.lower('text'), '[^' + chr(92) + 'p{L}' + chr(92) + 'p{M}' + chr(92) + 'p{N}]+'), 't', chr(116) + ' <> ' + chr(39) * 2), 't', 'cast((' + chr(39) + '0x' + chr(39) + ' || substr(sha256(t), 2, 1)) as integer)')}, []), [-1])) as d from pass",
            "embc": "select document_id, id, sequence, paragraph_index, d, count(*) as c from emb group by all",
            "embn": "select document_id, id, sum(c * c) filter (where d >= 0) as n from embc group by document_id, id",
            "vecd": f"select p.document_id, p.id, p.sequence, p.paragraph_index, g.range as d, coalesce(case when n > 0 then cast(round(cast(cast({unit} * cast(1000 as float) as float) as double)) / 1000 as float) end, cast(0 as float)) as v from pass p cross join {digits} g left join embc c on c.document_id = p.document_id and c.id = p.id and c.d = g.range left join embn e on e.document_id = p.document_id and e.id = p.id",
            "vec": "select document_id, id, sequence, paragraph_index, list(v order by d) as vector, sqrt(sum(cast(v as double) * cast(v as double))) as norm from vecd group by document_id, id, sequence, paragraph_index",
            "edge": f"select document_id, a, b, similarity from (select x.document_id, x.sequence as a, y.sequence as b, x.paragraph_index = y.paragraph_index as same, case when x.norm = 0 or y.norm = 0 then 0 else list_dot_product(cast(x.vector as double[]), cast(y.vector as double[])) / (x.norm * y.norm) end as similarity from vec x join vec y on x.document_id = y.document_id and x.sequence < y.sequence) where similarity >= {R.COSINE_ANY} or (same and similarity >= {R.COSINE_SAME_PARAGRAPH})",
            "reach": "select document_id, sequence as node, sequence as root from pass union select r.document_id, case when e.a = r.node then e.b else e.a end, r.root from reach r join edge e on e.document_id = r.document_id and (e.a = r.node or e.b = r.node)",
            "member": "select document_id, node as sequence, min(root) as root from reach group by document_id, node",
            "pairr": self._pairs("prop", "relation_tokens", R.RELATED),
            "lex": "select document_id, case when turned then id_r else id_l end as from_id, case when turned then id_l else id_r end as to_id, kind, case kind when 'contradicts' then 0.72 when 'generalizes' then 0.68 else 0.66 end as confidence from (select *, kind = 'generalizes' and claim_kind_r = 'universal' as turned from (select *, " + f"case when negated_l <> negated_r and overlap >= {R.OPPOSED} then 'contradicts' when (claim_kind_l = 'universal') <> (claim_kind_r = 'universal') then 'generalizes' when claim_kind_l = 'conditional' or claim_kind_r = 'conditional' then 'supports' end as kind from pairr)) where kind is not null",
            "pairv": self._pairs("prop", "content_tokens", R.VARIANT),
            "var": "select document_id, id_l as from_id, id_r as to_id, 'variant_of' as kind, overlap as confidence from pairv where id_l <> id_r and negated_l = negated_r and fingerprint_l <> fingerprint_r and (claim_kind_l = claim_kind_r or claim_kind_l = 'atomic' or claim_kind_r = 'atomic')",
            "rel": "select * from lex union all select * from var",
            "deg": "select document_id, id, count(*) as degree from (select document_id, from_id as id from rel union all select document_id, to_id from rel) group by document_id, id",
            "src": f"select p.document_id, p.id, bool_or(end_byte > start_byte and {D.trim('s.text')} <> '') as placed, bool_or({D.good_passage('s.text')}) as good, min(s.sequence) as first_sequence, arg_min(s.paragraph_index, s.sequence) as first_paragraph from (select document_id, id, unnest(fragment_ids) as f from prop) p join pass s on s.document_id = p.document_id and s.id = p.f group by p.document_id, p.id",
            "sc": f"select p.*, {D.lower('canonical_text')} as lower, {D.words('canonical_text')} as n_words, coalesce(r.role, 'unknown') as role, placed, good, first_sequence, first_paragraph, least(1.0, coalesce(degree, 0) * 0.25) as relation_score from prop p left join rolelast r on r.document_id = p.document_id and r.claim_id = p.id left join deg d on d.document_id = p.document_id and d.id = p.id left join src s on s.document_id = p.document_id and s.id = p.id",
            "sc2": f"select *, {D.philosophical_score('lower', 'domain', 'claim_kind')} as philosophical_score, {D.specificity_score('lower', 'n_words')} as specificity_score, case when placed is null then 0.2 else {D.clamp('(cast(0.55 as double) + case when placed then cast(0.25 as double) else 0 end + case when good then cast(0.2 as double) else 0 end)')} end as source_quality_score, {D.role_score('role')} as role_score from sc",
            "score": f"select *, {D.final_score('confidence', 'philosophical_score', 'specificity_score', 'source_quality_score', 'role_score', 'relation_score')} as final_rank_score from sc2",
            "ranked": "select *, row_number() over (partition by document_id order by final_rank_score desc, confidence desc, first_sequence nulls last, id) as place from score",
            "claimc": "select c.document_id, m.root, c.pos, c.id as claim_id, r.role from cand c join member m on m.document_id = c.document_id and m.sequence = c.pos left join rolelast r on r.document_id = c.document_id and r.claim_id = c.id",
            "argg": "select document_id, root, count(*) as n, coalesce(arg_min(claim_id, pos) filter (where role in ('conclusion', 'main_claim')), arg_max(claim_id, pos)) as conclusion from claimc group by document_id, root",
            "norm": "select document_id, canonical_text, arg_min(id, pos) as id, max(confidence) as confidence, arg_min(claim_kind, pos) as claim_kind from prop group by document_id, canonical_text",
        }
        self.steps = {k: v for k, v in self.steps.items()}
        self.recursive = {"reach"}

    @staticmethod
    def _pairs(table: str, tokens: str, least: float) -> str:
        flat = f"(select document_id, pos, id, claim_kind, negated, fingerprint, len({tokens}) as n, unnest({tokens}) as token from {table})"
        cols = ", ".join(f"{s}.{c} as {c}_{s}" for s in "lr" for c in ("pos", "id", "claim_kind", "negated", "fingerprint", "n"))
        names = ", ".join(f"{c}_{s}" for s in "lr" for c in ("pos", "id", "claim_kind", "negated", "fingerprint", "n"))
        return f"select *, common / (n_l + n_r - common) as overlap from (select document_id, {names}, count(*) as common from (select l.document_id, {cols} from {flat} l join {flat} r on l.document_id = r.document_id and l.token = r.token and l.pos < r.pos) group by all) where common / (n_l + n_r - common) >= {least}"

    def sql(self, query: str) -> str:
        import re

        needed: list[str] = []

        def visit(text: str) -> None:
            for name in self.steps:
                if name not in needed and re.search(rf"\b(?:from|join)\s+\(*{name}\b", text):
                    needed.append(name)
                    visit(self.steps[name])

        visit(query)
        order = [n for n in self.steps if n in needed]
        return "with recursive " + ",\n".join(f"{n} as ({self.steps[n]})" for n in order) + "\n" + query


DOCS, CONV = Steps(DOCUMENTS), Steps(CHATS)
_R = "round(cast({} as double), 6)"

ORACLES = {
    "ingest_normalize": DOCS.sql("select document_id, run_id, raw_text_hash, cast(strlen(text) as bigint) as n_bytes from ing"),
    "segment_sentences": DOCS.sql("select document_id, cast(pos as bigint) as pos, paragraph_index, start_byte, end_byte, sha256(text) as text_hash, cast(n_words as bigint) as n_words from sent"),
    "segment_passages": DOCS.sql("select id, document_id, paragraph_index, sequence, locator, start_byte, end_byte, sha256(text) as text_hash from pass"),
    "canonical_text": f"select conv_id, turn, {D.canonical_done('bare')} as canonical_text, cast({D.words('bare')} as bigint) as n_words from (select conv_id, turn, {D.canonical('text')} as bare from conversations)",
    "extract_claims": DOCS.sql("select document_id, cast(pos as bigint) as pos, fragment_id, id, claim_kind, confidence, negated, domain, case when confidence >= 0.55 then 'accepted' else 'exploring' end as assertion_status from cand"),
    "claim_kind_counts": DOCS.sql("select claim_kind, count(*) as n from cand group by claim_kind"),
    "confidence_histogram": DOCS.sql("select confidence, count(*) as n from cand group by confidence"),
    "domain_counts": DOCS.sql("select coalesce(domain, 'none') as domain, count(*) as n from cand group by 1"),
    "negation_counts": CONV.sql("select negated, claim_kind, count(*) as n from cand group by negated, claim_kind"),
    "claim_roles": DOCS.sql("select document_id, cast(pos as bigint) as pos, claim_id, primary_role from role"),
    "terms_heuristic": DOCS.sql(f"select document_id, 'term_' || substr(sha256(label), 1, 16) as id, arg_min(word, k) as text, label as normalized_label, case when lexicon then 'concept' else 'other' end as term_type, cast(count(distinct passage_id) as bigint) as n_passages, case when lexicon then 0.78 else 0.52 end as confidence from (select *, label in ({', '.join(map(D.text, R.LEXICON))}) as lexicon, sequence * 1000000 + n as k from (select document_id, passage_id, sequence, word, n, {D.lower(D.replace('word', '^[^' + chr(92) + 'p{L}' + chr(92) + 'p{M}' + chr(92) + 'p{N}]+|[^' + chr(92) + 'p{L}' + chr(92) + 'p{M}' + chr(92) + 'p{N}]+$'))} as label from (select document_id, id as passage_id, sequence, unnest(ws) as word, generate_subscripts(ws, 1) as n from (select document_id, id, sequence, string_split_regex(text, '[^\\p{{L}}\\p{{M}}\\p{{N}}'']+') as ws from pass)) where strlen(word) > 2)) where label <> '' and (lexicon or regexp_matches(word, '^\\p{{Lu}}')) group by document_id, label, lexicon"),
    "embed_hash16": CONV.sql("select document_id, id as passage_id, array_to_string(list_transform(vector, lambda v: cast(cast(round(cast(v as double) * 1000) as bigint) as varchar)), ' ') as thousandths from vec"),
    "cosine_edges": CONV.sql(f"select document_id, a, b, {_R.format('similarity')} as similarity from edge"),
    "vector_topk": "with q as (select vec_id as query_id, embedding as query from embeddings where vec_id % 20 = 0), s as (select query_id, vec_id, round(list_dot_product(cast(query as double[]), cast(embedding as double[])) / (sqrt(list_dot_product(cast(query as double[]), cast(query as double[]))) * sqrt(list_dot_product(cast(embedding as double[]), cast(embedding as double[])))), 6) as similarity from q cross join embeddings where vec_id <> query_id), r as (select *, row_number() over (partition by query_id order by similarity desc, vec_id) as place from s) select query_id, place, vec_id, similarity from r where place <= 10",
    "passage_clusters": CONV.sql("select m.document_id, m.sequence, m.root as representative, case when count(*) over (partition by m.document_id, m.root) > 1 then 0.72 else 0.5 end as confidence from member m"),
    "argument_links": CONV.sql("select c.document_id, c.root as representative, c.claim_id as from_id, a.conclusion as to_id, cast(count(*) as bigint) as n from claimc c join argg a on a.document_id = c.document_id and a.root = c.root where a.n >= 2 and c.claim_id <> a.conclusion group by 1, 2, 3, 4"),
    "dedup_propositions": DOCS.sql("select document_id, cast(pos as bigint) as pos, id, fingerprint, claim_kind, negated, confidence, array_to_string(fragment_ids, ' ') as fragment_ids, coalesce(array_to_string(duplicate_ids, ' '), '') as duplicate_ids from prop"),
    "dedup_diagnostics": DOCS.sql("select document_id, 'fingerprint_duplicate_merged' as code, kept as target_id, id || ' says the same as ' || kept as message from first where nth > 1 and canonical_text <> kept_text"),
    "relations_lexical": DOCS.sql("select document_id, from_id, to_id, kind, cast(confidence as double) as confidence from lex"),
    "relations_variant": DOCS.sql(f"select document_id, from_id, to_id, kind, {_R.format('confidence')} as confidence from var"),
    "score_breakdown": DOCS.sql("select document_id, id, role, philosophical_score, specificity_score, cast(source_quality_score as double) as source_quality_score, role_score, cast(relation_score as double) as relation_score, final_rank_score, cast(first_sequence as bigint) as first_sequence, cast(first_paragraph as bigint) as first_paragraph from score"),
    "rank_topk": DOCS.sql("select document_id, cast(place as bigint) as place, id, final_rank_score from ranked where place <= 5"),
    "normalized_propositions": DOCS.sql("select document_id, n.id, canonical_text, claim_kind, coalesce(r.role, 'unknown') as role, confidence from norm n left join (select document_id as d, claim_id, role from rolelast) r on r.d = n.document_id and r.claim_id = n.id"),
    "formalizations": DOCS.sql(f"select document_id, 'formal_' || id as id, case when contains({D.lower('canonical_text')}, ' not ') then 'Not (True)' else 'True' end as lean_expression, case when contains({D.lower('canonical_text')}, ' not ') then '{{\"kind\":\"not\",\"value\":{{\"args\":[],\"kind\":\"atomic\",\"predicate\":\"' || id || '\"}}}}' else '{{\"args\":[],\"kind\":\"atomic\",\"predicate\":\"' || id || '\"}}' end as ast from norm"),
    "evaluations": DOCS.sql(f"select document_id, 'formal_' || id as formalization_id, sha256('-- Lean binary: lean' || chr(10) || 'def formal_' || id || ' : Prop := ' || case when contains({D.lower('canonical_text')}, ' not ') then 'Not (True)' else 'True' end || chr(10) || '#check formal_' || id || chr(10)) as source_hash from norm"),
    "worldview_facets": DOCS.sql("select document_id, id as proposition_id, 'claim_kind' as family, claim_kind as value, confidence from prop union all select document_id, id, 'philosophical_domain', domain, confidence from prop where domain is not null"),
    "worldview_relations": DOCS.sql("select document_id, 'relation_' || from_id || '_' || kind || '_' || to_id as id, kind from rel"),
    "stage_summaries": DOCS.sql("select 'ingest' as name, count(*) as output_count from ing union all select 'segment', count(*) from pass union all select 'extract_claims', count(*) from cand union all select 'classify_roles', count(*) from role union all select 'normalize_propositions', count(*) from prop union all select 'relate', count(*) from rel"),
    "claim_labels": f"select event_type, count(*) as n, min(case when {D.matches(D.lower('event_type'), '^(premise|conclusion|definition)$')} then event_type else 'unknown' end) as role from events group by event_type",
    "span_violations": "with s as (select o_orderkey as id, 'o' || (o_custkey + case when o_orderkey % 97 = 0 then 1000000000 else 0 end) as source_id, case when o_orderkey % 89 = 0 then 1 else o_orderkey end as sequence, case when o_orderkey % 83 = 0 then ' ' else 'text' end as text, case when o_orderkey % 79 = 0 then 'md5:0' else 'sha256:' || sha256('text') end as content_hash from orders), c as (select 'o' || c_custkey as id from customer) select 'span_text' as code, 'span ' || id || ': no text' as message from s where trim(text) = '' union all select 'span_hash', id || ': the hash is no full sha256' from s where content_hash like 'md5%' union all select 'span_source', 'span ' || id || ': no source ' || source_id from s where source_id not in (select id from c) union all select 'sequence_repeated', 'source ' || source_id || ': twice the sequence ' || sequence from s group by source_id, sequence having count(*) > 1",
    "media_interval_join": "with e as (select event_id, user_id, epoch_us(ts) / 1000000.0 as s, epoch_us(ts) / 1000000.0 + value * 60 as e, event_type from events) select l.event_id as span_id, r.event_id as interval_id from e l join e r on l.user_id = r.user_id and l.s <= r.e and r.s <= l.e where l.event_type = 'click' and r.event_type = 'view'",
    "scalar_slice_offsets": "select doc_id, substring(text, 11, 20) as slice, cast(strlen(substring(text, 1, 10)) as bigint) as byte_start, cast(strlen(substring(text, 1, 30)) as bigint) as byte_end from documents",
    "record_revision": "select doc_id, 'sha256:' || sha256('{\"id\":\"d' || doc_id || '\",\"kind\":\"' || lang || '\",\"metadata\":{\"n_chars\":\"' || n_chars || '\"},\"uri\":null}') as revision from documents",
    "evidence_records": "with b as (select doc_id, 'sha256:' || sha256(text) as rev, 'family:source-record:sha256:' || sha256('[\"quill\",\"' || source || '\",\"d' || doc_id || '\"]') as family, source from documents), r as (select doc_id, '{\"class\":\"metadata\",\"familyId\":\"' || family || '\",' as head, '\"producer\":{\"name\":\"loader\",\"revision\":\"git:1\"},\"source\":{\"recordId\":\"d' || doc_id || '\",\"repository\":\"quill\",\"revision\":\"' || rev || '\",\"scopeId\":\"' || source || '\"}}' as tail from b) select doc_id, 'evidence:source-span:sha256:' || sha256(head || tail) as evidence_id, sha256(head || '\"id\":\"evidence:source-span:sha256:' || sha256(head || tail) || '\",' || tail) as record_hash from r",
    "source_segments": "select conv_id, 's' || conv_id || '_' || min(turn) as first_segment, cast(count(*) as bigint) as n_segments, sum(case when role = 'user' then cast(turn as double) end) as start_sum from conversations group by conv_id",
}
