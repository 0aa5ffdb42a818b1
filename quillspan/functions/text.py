"""Text rules as SQL expressions, for Spark and (for checks against an independent engine) DuckDB.

A :class:`Dialect` knows how an engine spells literals, patterns and lambdas; rules are written once on top of it.
"""

from __future__ import annotations

from dataclasses import dataclass

from . import rules as R

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Dialect:
    name: str

    @property
    def spark(self) -> bool:
        return self.name == "spark"

    def text(self, s: str) -> str:
        return "'" + (s.replace("\\", "\\\\").replace("'", "\\'") if self.spark else s.replace("'", "''")) + "'"

    def replace(self, x: str, pattern: str, by: str = "") -> str:
        """All matches of a pattern; groups in ``by`` are written \\1."""
        if self.spark:
            return f"regexp_replace({x}, {self.text(pattern)}, {self.text(by.replace('$', chr(92) + '$').replace(chr(92) + '1', '$1').replace(chr(92) + '2', '$2').replace(chr(92) + '3', '$3'))})"
        return f"regexp_replace({x}, {self.text(pattern)}, {self.text(by)}, 'g')"

    def matches(self, x: str, pattern: str) -> str:
        return f"({x} rlike {self.text(pattern)})" if self.spark else f"regexp_matches({x}, {self.text(pattern)})"

    def split(self, x: str, pattern: str) -> str:
        return f"split({x}, {self.text(pattern)})" if self.spark else f"string_split_regex({x}, {self.text(pattern)})"

    def fn(self, arg: str, body: str) -> str:
        return f"{arg} -> {body}" if self.spark else f"lambda {arg}: {body}"

    def filter(self, x: str, arg: str, body: str) -> str:
        return f"{'filter' if self.spark else 'list_filter'}({x}, {self.fn(arg, body)})"

    def map(self, x: str, arg: str, body: str) -> str:
        return f"{'transform' if self.spark else 'list_transform'}({x}, {self.fn(arg, body)})"

    def size(self, x: str) -> str:
        return f"{'size' if self.spark else 'len'}({x})"

    def bytes(self, x: str) -> str:
        return f"{'octet_length' if self.spark else 'strlen'}({x})"

    def sha256(self, x: str) -> str:
        return f"sha2({x}, 256)" if self.spark else f"sha256({x})"

    def sorted_set(self, x: str) -> str:
        return f"array_sort(array_distinct({x}))" if self.spark else f"list_sort(list_distinct({x}))"

    def join(self, x: str, by: str) -> str:
        return f"array_join({x}, {self.text(by)})" if self.spark else f"coalesce(array_to_string({x}, {self.text(by)}), '')"

    # rules

    def lower(self, x: str) -> str:
        """ASCII letters only."""
        return f"translate({x}, '{UPPER}', '{LOWER}')"

    def any_of(self, x: str, needles: list[str]) -> str:
        return "(" + " or ".join(f"contains({x}, {self.text(n)})" for n in needles) + ")"

    def trim(self, x: str) -> str:
        return f"trim(BOTH {self.text(R.WHITE_CHARS)} FROM {x})" if self.spark else f"trim({x}, {self.text(R.WHITE_CHARS)})"

    def left_trim(self, x: str) -> str:
        return f"trim(LEADING {self.text(R.WHITE_CHARS)} FROM {x})" if self.spark else f"ltrim({x}, {self.text(R.WHITE_CHARS)})"

    def right_trim(self, x: str) -> str:
        return f"trim(TRAILING {self.text(R.WHITE_CHARS)} FROM {x})" if self.spark else f"rtrim({x}, {self.text(R.WHITE_CHARS)})"

    def words(self, x: str) -> str:
        return self.size(self.filter(self.split(x, f"{R.WHITE}+"), "w", "w <> ''"))

    def starts(self, x: str, needles: list[str]) -> str:
        return self.matches(x, "^(?:" + "|".join(needles) + ")")

    def clamp(self, x: str) -> str:
        return f"(round(least(greatest({x}, 0.0D), 1.0D) * 100) / 100)" if self.spark else f"(round(least(greatest(cast({x} as double), 0.0), 1.0) * 100) / 100)"

    def number(self, v: float) -> str:
        return f"{v}D" if self.spark else f"cast({v} as double)"

    def canonical(self, x: str) -> str:
        """Trimmed, without leading bullets, white space collapsed, first letter upper case, closed by . ! or ?"""
        bare = self.trim(self.replace(self.replace(self.trim(x), f"^(?:[-*]{R.WHITE}*)+"), f"{R.WHITE}+", " "))
        return bare

    def canonical_done(self, bare: str) -> str:
        first, rest = f"substr({bare}, 1, 1)", f"substr({bare}, 2)"
        up = f"concat(translate({first}, '{LOWER}', '{UPPER}'), {rest})"
        return f"case when {bare} = '' then '' when substr({bare}, {'char_length' if self.spark else 'length'}({bare}), 1) in ('.', '!', '?') then {up} else concat({up}, '.') end"

    def is_question(self, text: str, lower: str) -> str:
        return f"({self.matches(text, f'[?]{R.WHITE}*$')} or {self.starts(lower, R.QUESTION_STARTS)})"

    def is_instruction(self, lower: str) -> str:
        return self.starts(lower, R.INSTRUCTION_STARTS)

    def cases(self, lower: str, table: list[tuple[str, list[str]]], other: str) -> str:
        return "case " + " ".join(f"when {self.any_of(lower, needles)} then '{name}'" for name, needles in table) + f" else {other} end"

    def claim_kind(self, lower: str) -> str:
        return self.cases(lower, R.CLAIM_KINDS, "'atomic'")

    def domain(self, lower: str) -> str:
        return self.cases(lower, R.DOMAINS, "null")

    def negated(self, lower: str) -> str:
        return f"({self.any_of(lower, R.NEGATIONS)} or {self.matches(lower, '^no ')})"

    def bonus(self, condition: str, v: float) -> str:
        return f"case when {condition} then {self.number(v)} else {self.number(0.0)} end"

    def confidence(self, text: str, lower: str, n_words: str, kind: str) -> str:
        total = self.number(0.5)
        for condition, v in (
            (self.matches(text, "[.!]$"), 0.08),
            (f"{n_words} >= 5", 0.06),
            (f"{kind} <> 'unknown'", 0.04),
            (self.any_of(lower, R.PREDICATE_NEEDLES), 0.07),
            (self.any_of(lower, R.HEDGES), -0.12),
        ):
            total = f"({total} + {self.bonus(condition, v)})"
        return self.clamp(f"least({total}, {self.number(0.85)})")

    def tokens(self, x: str, stopwords: list[str]) -> str:
        """The sorted set of tokens of more than two bytes that are no stop words."""
        split = self.split(self.lower(x), r"[^\p{IsAlphabetic}\p{N}]+" if self.spark else r"[^\p{L}\p{M}\p{N}]+")
        listed = ", ".join(map(self.text, stopwords))
        return self.sorted_set(self.filter(split, "t", f"{self.bytes('t')} > 2 and t not in ({listed})"))

    def fingerprint(self, content_tokens: str) -> str:
        listed = ", ".join(map(self.text, R.FINGERPRINT_STOPWORDS))
        return self.join(self.filter(content_tokens, "t", f"t not in ({listed})"), " ")

    def philosophical_score(self, lower: str, domain: str, kind: str) -> str:
        total = self.number(0.25)
        total = f"({total} + {self.bonus(f'{domain} is not null', 0.35)})"
        total = f"({total} + case when {kind} in ('conditional', 'definition', 'modal', 'normative', 'universal') then {self.number(0.25)} when {kind} = 'atomic' then {self.number(0.08)} else {self.number(0.0)} end)"
        total = f"({total} + {self.bonus(self.any_of(lower, R.CONCEPTS), 0.18)})"
        return self.clamp(f"({total} + {self.bonus(self.any_of(lower, R.REPORTAGE), -0.2)})")

    def specificity_score(self, lower: str, n_words: str) -> str:
        base = f"case when {n_words} between 5 and 35 then {self.number(0.65)} when {n_words} between 3 and 50 then {self.number(0.45)} else {self.number(0.25)} end"
        return self.clamp(f"({base} + {self.bonus(self.any_of(lower, R.CLEAR_PREDICATES), 0.25)})")

    def heading(self, text: str) -> str:
        """Short, without full stop, all letters upper case."""
        letters = r"[^\p{IsAlphabetic}\p{N}]" if self.spark else r"[^\p{L}\p{M}\p{N}]"
        bare = self.replace(text, f"^{letters}+|{letters}+$")
        lower_case = r"[\p{IsAlphabetic}&&[^\p{Lu}]]" if self.spark else r"[\p{Ll}\p{Lt}\p{Lm}\p{Lo}]"
        return f"({bare} <> '' and {self.bytes(bare)} <= 48 and not contains({bare}, '.') and not {self.matches(bare, lower_case)})"

    def good_passage(self, text: str) -> str:
        letter = r"\p{IsAlphabetic}" if self.spark else r"\p{L}"
        return f"({self.words(text)} >= 4 and {self.matches(text, letter)} and not {self.heading(self.trim(text))})"

    def role_score(self, role: str) -> str:
        return f"case {role} " + " ".join(f"when '{k}' then {self.number(v)}" for k, v in R.ROLE_SCORES.items()) + f" else {self.number(R.UNKNOWN_ROLE_SCORE)} end"

    def final_score(self, confidence: str, philosophical: str, specificity: str, quality: str, role: str, relation: str) -> str:
        n = self.number
        return self.clamp(f"({n(0.3)} * {confidence} + {n(0.25)} * {philosophical} + {n(0.15)} * {specificity} + {n(0.1)} * {quality} + {n(0.1)} * {role} + {n(0.1)} * {relation})")

    def identifier(self, x: str) -> str:
        bare = self.replace(x, "[^A-Za-z0-9_]", "_")
        return f"case when {self.matches(bare, '^[A-Za-z]')} then {bare} else concat('p', {bare}) end"

    def ingest(self, x: str) -> str:
        """Line ends as \\n, blank lines dropped, lines right-trimmed, the whole trimmed."""
        unix = self.replace(f"coalesce({x}, '')", "\r\n?", "\n")
        lines = self.split(unix, "\n")
        full = self.filter(lines, "l", f"{self.trim('l')} <> ''")
        return self.trim(self.join(self.map(full, "l", self.right_trim("l")), "\n"))


SPARK, DUCK = Dialect("spark"), Dialect("duck")
