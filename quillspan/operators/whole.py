"""Worldviews of whole documents: all stages of a document in one task, so that nothing but the text is moved.

The rules are those of the other operators; tests compare the results with theirs. What depends on Java's patterns is asked of the JVM.
"""

from __future__ import annotations

import gc
import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, count
from json.encoder import encode_basestring as quoted

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R
from ..session import ship
from ..sources.config import Config
from . import embed, relate, segment
from .claims import EXTRACTOR
from .rank import REASONS
from .worldview import PRODUCER

SCHEMA = "document_id string, worldview_id string, worldview string"
COLUMNS = ("id", "kind", "title", "authors", "language", "uri", "text")
#: Characters of results in one Arrow batch, readings and tokens a worker remembers, cells of a block of pairs.
BATCH, READINGS, TOKENS, CELLS = 4 << 20, 1 << 12, 1 << 18, 1 << 20
#: Read by numpy's library when a worker starts.
THREADS = "OPENBLAS_NUM_THREADS"

WHITE = "[" + re.escape(R.WHITE_CHARS) + "]"
UPPER = dict(zip("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
#: ASCII's letters and digits and all bytes beyond ASCII stay, other bytes become blanks.
BLANKED = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
BULLETS, SPACES = re.compile(f"^(?:[-*]{WHITE}*)+"), re.compile(f"{WHITE}+")
CUTS, GUARDS = re.compile(rf"([.!?]+{segment.CLOSERS})({WHITE}+)"), re.compile(rf"(?:{'|'.join(R.ABBREVIATIONS)})\.(?={WHITE})")
#: Python's white space that is none here; control characters in JSON.
OTHER_WHITE, CONTROL, SMALL = re.compile("[\x1c-\x1f]"), re.compile(r"(?<!\\)((?:\\\\)*)\\u00([01][0-9a-f])"), re.compile("[a-z]")
QUESTIONS, INSTRUCTIONS = tuple(R.QUESTION_STARTS), tuple(R.INSTRUCTION_STARTS)
RELATION_STOPWORDS, CONTENT_STOPWORDS, FINGERPRINT_STOPWORDS = (frozenset(w.encode() for w in words) for words in (R.RELATION_STOPWORDS, R.CONTENT_STOPWORDS, R.FINGERPRINT_STOPWORDS))
assert RELATION_STOPWORDS <= CONTENT_STOPWORDS
#: Needles of the claim rules by use; a claim's text holds only needles that its document's words hold.
NEEDLES = {
    "predicate": R.PREDICATE_NEEDLES, "hedge": R.HEDGES, "negation": R.NEGATIONS, "concept": R.CONCEPTS, "reportage": R.REPORTAGE, "clear": R.CLEAR_PREDICATES,
}


@lru_cache(1)
def classes(spark: SparkSession) -> dict[str, str]:
    r"""Java's sets of characters, as Python writes them: ``letter``, ``token`` (with numbers), ``small`` (letters but upper-case ones), ``inner`` (no ``\b`` between these and a letter), ``mark``, ``base``."""
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x34000), range(0xE0000, 0xE0200))))  # the rest is unassigned or private
    java = spark._jvm.java.util.regex.Pattern

    def ranges(chars: str) -> str:
        codes = np.array(sorted(set(map(ord, chars))))
        ends = np.flatnonzero(np.diff(codes) > 1)
        return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(codes[np.r_[0, ends + 1]], codes[np.r_[ends, len(codes) - 1]]))

    def held(pattern: str) -> str:
        return java.compile(f"[^{pattern}]+").matcher(every).replaceAll("")

    cut = java.compile(r"(?s)\n(.)\Ba").matcher("".join(f"\n{c}a" for c in every)).replaceAll("")
    found = {"letter": held(r"\p{IsAlphabetic}"), "token": held(r"\p{IsAlphabetic}\p{N}"), "small": held(r"[\p{IsAlphabetic}&&[^\p{Lu}]]"), "inner": sorted(set(every) - set(cut[1::3])), "mark": held(r"\p{Mn}"), "base": held(r"\p{L}\p{Nd}")}
    return {k: ranges(v) for k, v in found.items()}


@lru_cache(1 << 12)
def rounded(x: float) -> float:
    """To two decimals and into [0, 1], as ``Dialect.clamp``."""
    x = min(max(x, 0.0), 1.0) * 100
    whole = int(x)
    return (whole + (x - whole >= 0.5)) / 100


def holds(text: str, needles: list[str]) -> bool:
    for n in needles:  # noqa: SIM110 (any() over a generator takes twice as long)
        if n in text:
            return True
    return False


def first_case(text: str, table: list[tuple[str, list[str]]], other: str | None) -> str | None:
    for name, needles in table:
        for n in needles:
            if n in text:
                return name
    return other


def escaped(text: str) -> str:
    """A JSON string as Spark writes it."""
    out = quoted(text)
    return CONTROL.sub(lambda m: m[1] + "\\u00" + m[2].upper(), out) if "\\u00" in out else out


def ascii_lower(text: str) -> str:
    return text.lower() if text.isascii() else text.encode().lower().decode()


def listed(texts: list[str]) -> str:
    return "[" + ",".join(f'"{t}"' for t in texts) + "]"


class Buckets(dict):
    """The bucket of every token (as UTF-8), by the first byte of its SHA-256."""

    def __init__(self, dimensions: int):
        self.dimensions = dimensions

    def __missing__(self, token: bytes) -> int:
        if len(self) >= TOKENS:
            self.clear()
        found = self[token] = hashlib.sha256(token).digest()[0] % self.dimensions
        return found


class Claim:
    """What a passage's text says: everything that does not depend on its document."""

    __slots__ = ("id", "canonical", "shown", "kind", "confidence", "negated", "domain", "related", "content", "fingerprint", "philosophical", "specificity")


class Passage:
    __slots__ = ("buckets", "good", "claim", "text")


def near(sets: list[list[bytes]], least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(left, right, similarity) of all pairs of token sets with a Jaccard similarity of at least ``least`` (> 0), left < right.

    Tokens of many sets are counted by a product of matrices, others by their lists of sets; blocks of rows bound what is held.
    """
    n, codes = len(sets), {}
    sizes = np.fromiter(map(len, sets), np.int64, n)
    code, row, out = np.fromiter(map(codes.setdefault, chain.from_iterable(sets), count()), np.int64, int(sizes.sum())), np.repeat(np.arange(n), sizes), []
    df = np.bincount(code, minlength=1)
    shared = df[code] > 1
    enough = np.bincount(row[shared], minlength=n) >= sizes * least * (1 - 1e-6)  # others share too little with all sets together
    shared &= enough[row]
    code, row = code[shared], row[shared]
    if not len(code):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    df = np.bincount(code)
    common_codes = df >= max(16, n / 9)
    column = np.cumsum(common_codes) - 1
    often = common_codes[code]
    dense = np.zeros((n, column[-1] + 1), np.float32)
    dense[row[often], column[code[often]]] = 1
    code, row = code[~often], row[~often]
    if len(code):
        holders, ends = row[np.argsort(code, kind="stable")], np.cumsum(np.bincount(code, minlength=len(df)))
    work = np.cumsum(n + np.bincount(row, df[code], n))
    least_common = (sizes * (least / (1 + least)) * (1 - 1e-6)).astype(np.float32)  # a little less: the similarity decides below
    low = 0
    while low < n and (dense.shape[1] or len(code)):
        high = max(low + 1, int(np.searchsorted(work, (work[low - 1] if low else 0) + CELLS, "right")))
        common = dense[low:high] @ dense.T
        here = slice(*np.searchsorted(row, (low, high))) if len(code) else slice(0)
        many = df[code[here]]
        if len(many):
            place = np.repeat(ends[code[here]] - np.cumsum(many), many) + np.arange(many.sum())
            common += np.bincount(np.repeat((row[here] - low) * n, many) + holders[place], minlength=common.size).reshape(common.shape)
        i, j = np.nonzero(common >= least_common[low:high, None] + least_common[None, :])
        both = common[i, j].astype(np.float64)
        i += low
        similarity = both / np.maximum(sizes[i] + sizes[j] - both, 1)
        kept = (i < j) & (both > 0) & (similarity >= least)
        out.append((i[kept], j[kept], similarity[kept]))
        low = high
    return tuple(np.concatenate([o[k] for o in out]) if out else np.empty(0, np.int64) for k in range(3))


def vectors(buckets: list[bytes], dimensions: int, decimals: bool) -> np.ndarray:
    """As :func:`embed.hash_embedding`."""
    spot = np.repeat(np.arange(len(buckets)) * dimensions, [len(b) for b in buckets]) + np.frombuffer(b"".join(buckets), np.uint8)
    counts = np.bincount(spot, minlength=len(buckets) * dimensions).reshape(-1, dimensions).astype(np.float32)
    size = np.sqrt((counts * counts).sum(axis=1).astype(np.float64)).astype(np.float32)
    unit = counts / np.where(size > 0, size, np.float32(1))[:, None]
    return (np.floor((unit * np.float32(1000)).astype(np.float64) + 0.5) / 1000).astype(np.float32) if decimals else unit


def connected(own: np.ndarray) -> list[np.ndarray]:
    """Groups of two passages or more that :func:`embed.clusters` puts together; ingested documents have one paragraph."""
    own = own.astype(np.float64)
    norms = np.sqrt((own * own).sum(axis=1))

    def similar(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        scale = norms[left][:, None] * norms[right][None, :]
        return np.divide(own[left] @ own[right].T, scale, out=np.zeros(scale.shape), where=scale > 0) >= min(R.COSINE_SAME_PARAGRAPH, R.COSINE_ANY)

    open_, out, step = np.ones(len(own), bool), [], 128
    every = np.arange(len(own))
    whole = similar(every, every) if len(own) <= 512 else None
    if whole is not None:
        open_ = whole.sum(axis=1) > 1  # zero vectors are not even similar to themselves
    while len(first := np.flatnonzero(open_)[:1]):
        group = todo = first
        open_[first] = False
        while len(todo):
            head, todo = todo[:step], todo[step:]
            left = np.flatnonzero(open_)
            met = left[(whole[head][:, left] if whole is not None else similar(head, left)).any(axis=0)]
            open_[met] = False
            group, todo = np.concatenate((group, met)), np.concatenate((todo, met))
        if len(group) > 1:
            out.append(np.sort(group))
    return out


def quality(good: bool) -> float:
    return rounded(0.55 + 0.25 + (0.2 if good else 0.0))


@lru_cache(1 << 14)
def score(confidence: float, philosophical: float, specificity: float, good: bool, role: str, degree: int) -> float:
    """As ``Dialect.final_score``."""
    total = 0.3 * confidence + 0.25 * philosophical + 0.15 * specificity + 0.1 * quality(good) + 0.1 * R.ROLE_SCORES.get(role, R.UNKNOWN_ROLE_SCORE)
    return rounded(total + 0.1 * min(1.0, degree * 0.25))


@lru_cache(1 << 14)
def reasons(final: float, philosophical: float, specificity: float, good: bool, negated: bool, role: str, degree: int) -> str:
    """The reasons of ``rank.score`` as JSON."""
    facts = {
        "philosophical_score": philosophical, "role": role, "relation_score": min(1.0, degree * 0.25), "source_quality_score": quality(good), "specificity_score": specificity, "has_negation": negated,
    }
    return listed([*(name for test, name in CONDITIONS if eval(test, {}, facts)), f"final_rank_score:{final:.3f}"])  # noqa: S307 (fixed expressions)


class Reader:
    """Makes worldviews of documents; remembers what it read and the buckets of tokens."""

    def __init__(self, config: Config, signs: dict[str, str]):
        self.config = config
        self.dimensions = embed.RETRIEVAL_DIMENSIONS if config.rerank else embed.DIMENSIONS
        self.buckets, self.readings, self.pieces = Buckets(self.dimensions), {}, {}
        self.needles, self.kinds, self.domains = NEEDLES, R.CLAIM_KINDS, R.DOMAINS
        self.tokens, self.letter, self.small = (re.compile(f"[{signs[k]}]" + "+" * (k == "token")) for k in ("token", "letter", "small"))
        self.ends = re.compile(f"^[^{signs['token']}]+|[^{signs['token']}]+$")
        self.inner, self.mark, self.base = (re.compile(f"[{signs[k]}]") for k in ("inner", "mark", "base"))
        self.classifier = config.classification_backend == "text-linguistics"

    @staticmethod
    def words(text: str) -> list[str]:
        return [w for w in SPACES.split(text) if w] if OTHER_WHITE.search(text) else text.split()

    def split(self, lower: bytes) -> list[bytes]:
        """The tokens of a text in lower case; only words with characters beyond ASCII are looked at one by one, and remembered."""
        words = lower.translate(BLANKED).split()
        if lower.isascii():
            return words
        odd = {w: self.piece(w) for w in words if not w.isascii()}
        if all([found == [w] for w, found in odd.items()]):
            return words
        return [t for w in words for t in odd.get(w, (w,))]

    def piece(self, word: bytes) -> list[bytes]:
        found = self.pieces.get(word)
        if found is None:
            if len(self.pieces) >= TOKENS:
                self.pieces.clear()
            found = self.pieces[word] = [t.encode() for t in self.tokens.findall(word.decode())]
        return found

    @staticmethod
    def ingested(text: str | None) -> str:
        lines = (text or "").replace("\r\n", "\n").replace("\r", "\n").split("\n")
        return "\n".join(x for line in lines if (x := line.rstrip(R.WHITE_CHARS))).strip(R.WHITE_CHARS)

    def guarded(self, text: str) -> str:
        def put(m: re.Match) -> str:
            i = m.start() - 1
            if i >= 0 and self.mark.match(text, i):  # a mark belongs to the letter or digit before it
                while i >= 0 and self.mark.match(text, i):
                    i -= 1
                return m[0] if i >= 0 and self.base.match(text, i) else m[0] + segment.GUARD
            return m[0] if i >= 0 and self.inner.match(text, i) else m[0] + segment.GUARD

        return GUARDS.sub(put, text)

    def passages(self, text: str) -> list[tuple[int, str, list[str]]]:
        """(number of the first sentence, text, words) of a document's passages."""
        words = self.words if OTHER_WHITE.search(text) else str.split
        odd = segment.ESCAPE in text or segment.CUT in text
        if odd:
            text = text.replace(segment.ESCAPE, segment.ESCAPED_ESCAPE).replace(segment.CUT, segment.ESCAPED_CUT)
        out, held, number = [], 0, 0
        for piece in CUTS.sub(rf"\1{segment.CUT}\2", self.guarded(text)).split(segment.CUT):
            piece = piece.replace(segment.GUARD, "")
            if odd:
                piece = piece.replace(segment.ESCAPED_CUT, segment.CUT).replace(segment.ESCAPED_ESCAPE, segment.ESCAPE)
            piece = piece.strip(R.WHITE_CHARS)
            if not piece:
                continue
            number, own = number + 1, words(piece)
            if number == 1 or (held >= 3 and len(own) >= 3):
                out.append((number, piece, own))
            else:
                first, before, already = out[-1]
                out[-1] = first, f"{before} {piece}", already + own
            held += len(own)
        return out

    def narrow(self, text: str) -> None:
        """Leave out needles that the document, and so any of its claims, does not hold."""
        lower = ascii_lower(" ".join(self.words(text)))
        self.needles = {k: [n for n in needles if n in lower] for k, needles in NEEDLES.items()}
        self.kinds, self.domains = ([(name, held) for name, needles in table if (held := [n for n in needles if n in lower])] for table in (R.CLAIM_KINDS, R.DOMAINS))

    def heading(self, text: str) -> bool:
        bare = self.ends.sub("", text.strip(R.WHITE_CHARS))
        return bare != "" and len(bare.encode()) <= 48 and "." not in bare and not self.small.search(bare)

    def read(self, text: str, words: list[str]) -> Passage:
        found = self.readings.get(text)
        if found is None:
            if len(self.readings) >= READINGS:
                self.readings.clear()
            found = self.readings[text] = Passage()
            tokens = self.split(text.encode().lower())
            found.buckets, found.text = bytes(map(self.buckets.__getitem__, tokens)), escaped(text)
            found.good = len(words) >= 4 and (SMALL.search(text) is not None or (self.letter.search(text) is not None and not self.heading(text)))
            found.claim = self.claim(found, text, words, tokens)
        return found

    def claim(self, passage: Passage, text: str, words: list[str], tokens: list[bytes]) -> Claim | None:
        """As :func:`claims.extract` and :func:`dedup.with_tokens`, with the scores of the text alone."""
        if text[0] in "-*":
            words = self.words(BULLETS.sub("", text))
        n_words = len(words)
        if n_words < 3:
            return None
        c, bare = Claim(), " ".join(words)
        c.canonical = UPPER.get(bare[0], bare[0]) + bare[1:] + ("" if bare[-1] in ".!?" else ".")
        lower = ascii_lower(c.canonical)
        if lower[-1] == "?" or lower.startswith(QUESTIONS) or lower.startswith(INSTRUCTIONS):
            return None
        c.kind = first_case(lower, self.kinds, "atomic")
        total = 0.5 + 0.08  # texts end in . or ! here
        total = total + 0.06 if n_words >= 5 else total
        total = total + 0.04
        total = total + 0.07 if holds(lower, self.needles["predicate"]) else total
        total = total + -0.12 if holds(lower, self.needles["hedge"]) else total
        c.confidence = rounded(min(total, 0.85))
        c.negated = holds(lower, self.needles["negation"]) or lower.startswith("no ")
        c.domain = first_case(lower, self.domains, None)
        c.id = "p_" + hashlib.sha256(c.canonical.encode()).hexdigest()[:24]
        c.shown = passage.text if c.canonical == text else escaped(c.canonical)
        c.related = c.content = bare_words = sorted([t for t in set(tokens) - RELATION_STOPWORDS if len(t) > 2])
        if not CONTENT_STOPWORDS.isdisjoint(c.related):
            c.content = bare_words = [t for t in c.related if t not in CONTENT_STOPWORDS]
        if not FINGERPRINT_STOPWORDS.isdisjoint(c.content):
            bare_words = [t for t in c.content if t not in FINGERPRINT_STOPWORDS]
        c.fingerprint = b" ".join(bare_words).decode()
        total = 0.25 + 0.35 if c.domain is not None else 0.25
        total = total + (0.08 if c.kind == "atomic" else 0.25)
        total = total + 0.18 if holds(lower, self.needles["concept"]) else total
        c.philosophical = rounded(total + -0.2 if holds(lower, self.needles["reportage"]) else total)
        base = 0.65 if 5 <= n_words <= 35 else 0.45 if 3 <= n_words <= 50 else 0.25
        c.specificity = rounded(base + 0.25 if holds(lower, self.needles["clear"]) else base)
        return c

    def roles(self, said: list[tuple[int, Claim]]) -> dict[str, str]:
        """The role of every claim id: of its last place."""
        out = {}
        for k, (_, c) in enumerate(said):
            last = k == len(said) - 1
            if self.classifier:
                lower = ascii_lower(c.canonical)
                role = "conclusion" if holds(lower, ["because", "therefore"]) else "example" if "for example" in lower else "premise"
            elif c.kind == "conditional":
                role = "conclusion" if last else "premise"
            else:
                role = {"definition": "definition", "normative": "main_claim"}.get(c.kind) or ("conclusion" if last and len(said) > 1 else "premise")
            out[c.id] = role
        return out

    def arguments(self, read: list[Passage], role: dict[str, str]) -> list[tuple[str, str]]:
        """(premise, conclusion) of the arguments that clusters of passages give."""
        out = []
        if sum(p.claim is not None for p in read) < 2:
            return out
        for group in connected(vectors([p.buckets for p in read], self.dimensions, not self.config.rerank)):
            ids = [c.id for k in group if (c := read[k].claim) is not None]
            if len(ids) >= 2:
                end = next((i for i in ids if role[i] in ("conclusion", "main_claim")), ids[-1])
                out += [(i, end) for i in ids if i != end]
        return out

    @staticmethod
    def related(props: list[tuple]) -> list[tuple[int, int, str]]:
        """(left, right, kind) of related propositions, left < right: see ``relate``; ``generalizes`` may have to be turned."""
        out = []
        held = [p[0] for p in props]
        i, j, similarity = near([c.related for c in held], R.RELATED)
        for a, b, s in zip(i.tolist(), j.tolist(), similarity.tolist()):
            x, y = held[a], held[b]
            if x.negated != y.negated and s >= R.OPPOSED:
                out.append((a, b, "contradicts"))
            elif (x.kind == "universal") != (y.kind == "universal"):
                out.append((a, b, "generalizes"))
            elif x.kind == "conditional" or y.kind == "conditional":
                out.append((a, b, "supports"))
        if any([len(c.related) != len(c.content) for c in held]):
            i, j, similarity = near([c.content for c in held], R.VARIANT)
        for a, b, s in zip(i.tolist(), j.tolist(), similarity.tolist()):
            x, y = held[a], held[b]
            if s >= R.VARIANT and x.negated == y.negated and x.fingerprint != y.fingerprint and (x.kind == y.kind or "atomic" in (x.kind, y.kind)):
                out.append((a, b, "variant_of"))
        return out

    def propositions(self, said: list[tuple[int, Claim]], good: list[bool]) -> list[tuple]:
        """(first claim, passages, merged ids, confidence, good) of claims that say the same, as :func:`dedup.merge`."""
        groups: dict[tuple, list[tuple[int, Claim]]] = {}
        for k, c in said:
            if c.confidence >= self.config.min_confidence:
                groups.setdefault((c.fingerprint, c.kind, c.negated), []).append((k, c))
        return [
            (g[0][1], [k for k, _ in g], sorted({c.id for _, c in g[1:]}), max(c.confidence for _, c in g), any(good[k] for k, _ in g)) if len(g) > 1 else (g[0][1], [g[0][0]], [], g[0][1].confidence, good[g[0][0]])
            for g in groups.values()
        ]

    def ranked(self, props: list[tuple], role: dict[str, str], degree: dict[str, int]) -> list[tuple[float, tuple]]:
        """(final score, proposition) in order, as :func:`rank.rank`."""
        scored = [(score(p[3], p[0].philosophical, p[0].specificity, p[4], role[p[0].id], degree.get(p[0].id, 0)), p) for p in props]
        return sorted(scored, key=lambda x: (-x[0], -x[1][3], x[1][1][0], x[1][0].id))

    def found(self, order: list[tuple], related: list[tuple[int, int, str]]) -> list[tuple[str, str, str, str]]:
        """Relations (from, to, kind, note) of propositions in this order."""
        out = []
        for a, b, kind in related:
            x, y = order[a][0], order[b][0]
            if kind == "generalizes" and y.kind == "universal":
                x, y = y, x
            out.append((x.id, y.id, kind, relate.NOTES[kind]))
        return out

    def worldview(self, row: dict) -> tuple[str, str, str] | None:
        text = self.ingested(row["text"])
        if not text:
            return None
        text_hash = hashlib.sha256(text.encode()).hexdigest()
        document = (row["id"] or "").strip(R.WHITE_CHARS) or f"doc_{text_hash[:16]}"
        self.narrow(text)
        passages = self.passages(text)
        read = [self.read(t, w) for _, t, w in passages]
        said = [(k, p.claim) for k, p in enumerate(read) if p.claim is not None]
        role, props = self.roles(said), self.propositions(said, [p.good for p in read])
        relations: list[tuple[str, str, str, str]] = []
        degree: dict[str, int] = defaultdict(int)
        pairs = self.related(props) if self.config.include_relations else []
        for a, b, _ in pairs:
            degree[props[a][0].id] += 1
            degree[props[b][0].id] += 1
        order = [p for _, p in self.ranked(props, role, degree)][: self.config.max_propositions] if pairs or self.config.max_propositions is not None else props
        if pairs:
            place = {id(p): k for k, p in enumerate(order)}
            spots = [place.get(id(p)) for p in props]
            relations = self.found(order, [(*sorted((spots[a], spots[b])), kind) for a, b, kind in pairs if spots[a] is not None and spots[b] is not None])
        if self.config.include_relations:
            relations += [(a, b, "supports", relate.NOTES["argument"]) for a, b in self.arguments(read, role)]
        degree.clear()
        variants: dict[str, list[str]] = defaultdict(list)
        for a, b, kind, _ in relations:
            degree[a] += 1
            degree[b] += 1
            if kind == "variant_of":
                variants[a].append(b)
                variants[b].append(a)
        shown = escaped(document)
        names = [f'"frag_{shown[1:-1]}_{k}"' for k in range(1, len(passages) + 1)]
        made = [self.proposition(final, p, role[p[0].id], degree[p[0].id], variants, names) for final, p in self.ranked(order, role, degree)]
        links = [f'{{"id":"relation_{a}_{kind}_{b}","fromPropositionId":"{a}","toPropositionId":"{b}","kind":"{kind}","note":"{note}"}}' for a, b, kind, note in sorted(relations)]
        sources = [f'{{"id":{name},"documentId":{shown},"locator":"paragraph 1, sentence {first}","text":{p.text}}}' for name, (first, _, _), p in zip(names, passages, read)]
        own = self.config.worldview_id if self.config.worldview_id and self.config.worldview_id.strip() else f"draft-worldview-{text_hash[:16]}"
        label = next(x for x in (self.config.label, row["title"], "Draft philosophical worldview") if x is not None)
        about = {"id": shown, "kind": escaped(row["kind"] or "philosophical_text"), "title": row["title"] and escaped(row["title"]), "authors": "[" + ",".join("null" if a is None else escaped(a) for a in row["authors"]) + "]" if row["authors"] else None}
        about |= {k: row[k] if row[k] is None else escaped(row[k]) for k in ("title", "language", "uri")}
        source = ",".join(f'"{k}":{v}' for k, v in about.items() if v is not None)
        return document, own, (
            f'{{"schemaVersion":"10","id":{escaped(own)},"fragment":"unified_worldview_v2","label":{escaped(label)},"propositions":[{",".join(made)}],"relations":[{",".join(links)}],"sourceDocuments":[{{{source}}}],'
            f'"sourceFragments":[{",".join(sources)}],"metadata":{{"generatedBy":"{PRODUCER}","provider":"{PRODUCER}","reviewRequired":true,"source":"text_extraction","targetContract":"unified worldview v10"}}}}'
        )

    def proposition(self, final: float, prop: tuple, role: str, degree: int, variants: dict[str, list[str]], names: list[str]) -> str:
        c, places, merged, confidence, good = prop
        why = reasons(final, c.philosophical, c.specificity, good, c.negated, role, degree)
        spots = "[" + ",".join([names[k] for k in places]) + "]"
        status = "accepted" if confidence >= 0.55 else "exploring"
        domain = "" if c.domain is None else f',{{"family":"philosophical_domain","value":"{c.domain}","provenance":"heuristic","confidence":{confidence}}}'
        return (
            f'{{"id":"{c.id}","canonicalText":{c.shown},"assertions":[{{"id":"assertion_{c.id}","status":"{status}","provenance":"generated","confidence":{confidence},"sourceFragmentIds":{spots}}}],"sourceFragmentIds":{spots},'
            f'"facets":[{{"family":"claim_kind","value":"{c.kind}","provenance":"heuristic","confidence":{confidence}}}{domain}],"metadata":{{"claimKind":"{c.kind}","confidence":{confidence},'
            + ("" if c.domain is None else f'"domain":"{c.domain}",') + (f'"duplicateSourceIds":{listed(merged)},' if merged else "") + f'"extractor":"{EXTRACTOR}","finalRankScore":{final},"generatedBy":"{PRODUCER}",'
            f'"negated":{"true" if c.negated else "false"},"normalizedFingerprint":"{c.fingerprint}","philosophicalScore":{c.philosophical},"provider":"{PRODUCER}","reviewRequired":true,"scoreReasons":{why},'
            f'"sourceQualityScore":{quality(good)},"specificityScore":{c.specificity}' + (f',"variantOfIds":{listed(sorted(variants[c.id]))}' if c.id in variants else "") + "}}"
        )


#: The reasons of ``rank`` as Python's conditions.
CONDITIONS = [(compile(test, name, "eval"), name) for test, name in REASONS]


def worldviews(documents: DataFrame, config: Config = Config()) -> DataFrame:
    """document_id, worldview_id and the JSON text of every document's worldview, one row for each document that is not empty.

    Documents are dealt out evenly, as a table may come in one piece; a document and its pairs of claims are held by one task.
    """
    spark = documents.sparkSession
    ship(spark)
    signs, environment = classes(spark), spark.sparkContext.environment

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, rows, held = Reader(config, signs), [], 0

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(3)], ["document_id", "worldview_id", "worldview"])

        gc.disable()  # nothing here refers to itself, and looking for that takes a tenth of the time
        try:
            for batch in batches:
                for k in range(batch.num_rows):
                    made = reader.worldview({name: batch.column(c)[k].as_py() for c, name in enumerate(COLUMNS)})
                    if made is not None:
                        rows.append(made)
                        held += len(made[2])
                    if held >= BATCH:
                        yield packed()
                        rows, held = [], 0
            if rows:
                yield packed()
        finally:
            gc.enable()

    before = environment.get(THREADS)
    environment[THREADS] = "1"  # small matrices: more threads only wait for each other
    try:
        return documents.select(*COLUMNS).repartition(F.xxhash64("id", "text")).mapInArrow(run, SCHEMA)
    finally:
        environment.pop(THREADS)
        if before is not None:
            environment[THREADS] = before
