"""Format-preserving pseudonyms for personal data by keyed Feistel networks (operator 6), in DataFrame operations only.

Candidates are found by one pattern, checked (Luhn sums of card numbers, octets of addresses, areas of social security
numbers, the calendar for dates), and permuted within their format by a Feistel network whose round function is SHA-256 under
the key. A permutation is one to one, and depends on value and key alone: equal values have equal pseudonyms in every
document, different values different ones, and no table of values is kept. Separators stay where they were. What is
written differently (``+1 (974) 555-3436``, ``974-555-3436``) but has the same digits gets the same digits.

=========  =================================================================================================
email      local part becomes 16 hex digits of a keyed hash, the domain ``pii.invalid``
ip         dotted IPv4 address, every octet up to 255; permuted among all addresses
ssn        ddd-dd-dddd with a valid area, group and serial; permuted among valid ones
date       yyyy-mm-dd or yyyy/mm/dd, a day of 1800-2199 that exists; permuted among those 146,097 days
phone      ten digits with separators or brackets, with or without +1; area code, exchange and line permuted among those of the
           same form (area code and exchange each from 200 on, as valid ones are, or below)
card       13 to 19 digits with a right Luhn sum; permuted, with a new check digit
secret     the quoted hexadecimal value of a token, secret, key or password, in either case; digits from a keyed hash
=========  =================================================================================================

Candidates that fail their check stay as they are. Defined results: a null text stays null, with counts of 0; repeated rows
give repeated rows; no rows give no rows; ``pseudonymise`` keeps extra columns.
"""

from __future__ import annotations

import secrets

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import spare, table

#: The session setting with the key. A session without one gets a random key of its own, so nobody else can invert its pseudonyms,
#: but those of another session don't link to them.
SETTING, ROUNDS = "spark.quillspan.pii.key", 8
KINDS = ("email", "ip", "ssn", "date", "phone", "card", "secret")
#: One alternative per kind; each begins where a run begins, so long runs are tried once.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}_%+-](?:[\p{L}\p{N}._%+-]{0,63})@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}(?![A-Za-z0-9-])",
    "ip": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "date": r"(?<![\d/-])\d{4}(?:-\d{2}-|/\d{2}/)\d{2}(?![\d/-])",
    "phone": r"(?<![\d+])(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\d])",
    "card": r"(?<![\d-])\d(?:[ -]?\d){12,18}(?![\d-])",
    "secret": r"(?<=(?i:token|secret|key|password) ?[=:] ?\")[0-9A-Fa-f]{16,128}(?=\")",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What every match holds; other texts are left alone at once.
CUE = r"[0-9@]|[=:] ?\"[A-Fa-f]{16}"


def session_key(spark: SparkSession) -> str:
    """The key of the session's setting, which is set at random where it is missing."""
    key = spark.conf.get(SETTING, None)
    if not key:
        key = secrets.token_hex(32)
        spark.conf.set(SETTING, key)
    return key


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(value: str, name: str, then: str) -> str:
    return f"get(transform(array({value}), {name} -> {then}), 0)"


def _round(key: str, kind: str, i: str, half: str) -> str:
    return f"cast(conv(substr(sha2(concat_ws('|', {_quoted(key)}, '{kind}', {i}, {half}), 256), 1, 12), 16, 10) as bigint)"


def feistel(left: str, right: str, a: str, b: str, kind: str, key: str) -> str:
    """struct(l, r): a permutation of pairs below a and b; even rounds move the left part, odd rounds the right part."""
    return f"""aggregate(sequence(0, {ROUNDS - 1}), struct(cast({left} as bigint) as l, cast({right} as bigint) as r), (s, i) ->
        if(i % 2 = 0, struct(pmod(s.l + {_round(key, kind, 'i', 's.r')}, {a}) as l, s.r as r), struct(s.l as l, pmod(s.r + {_round(key, kind, 'i', 's.l')}, {b}) as r)))"""


def _power(n: str) -> str:
    return f"cast(rpad('1', {n} + 1, '0') as bigint)"


def digits(d: str, kind: str, key: str) -> str:
    """A run of digits permuted among all runs of that length (2 to 36)."""
    n, half = f"char_length({d})", f"(char_length({d}) div 2)"
    mixed = feistel(f"substr({d}, 1, {half})", f"substr({d}, {half} + 1)", _power(half), _power(f"({n} - {half})"), kind, key)
    return _let(mixed, "p", f"concat(lpad(p.l, {half}, '0'), lpad(p.r, {n} - {half}, '0'))")


def _refill(match: str, fresh: str) -> str:
    """Put the digits of ``fresh`` where ``match`` has digits."""
    return f"""aggregate(split({match}, ''), struct('' as out, 1 as at), (s, c) ->
        if(c >= '0' and c <= '9' and c <> '', struct(concat(s.out, substr({fresh}, s.at, 1)) as out, s.at + 1 as at), struct(concat(s.out, c) as out, s.at as at)), s -> s.out)"""


def _luhn(d: str, check: bool) -> str:
    """The Luhn sum of a run of digits; without its check digit, the doubled places begin at the last."""
    odd = 0 if check else 1
    return f"aggregate(sequence(1, char_length({d})), 0, (s, j) -> s + {_let(f'cast(substr({d}, j, 1) as int) * if((char_length({d}) - j + {odd}) % 2 = 1, 2, 1)', 'v', 'if(v > 9, v - 9, v)')})"


def _pseudonyms(key: str) -> dict[str, str]:
    """For each kind the pseudonym of the match ``m`` as SQL, null where its check fails."""
    only = "regexp_replace(m, '[^0-9]', '')"
    ten = f"right({only}, 10)"
    octets = "transform(split(m, '[.]'), o -> cast(o as bigint))"
    ip = _let(octets, "o", "if(exists(o, x -> x > 255), null, " + _let(feistel("o[0] * 256 + o[1]", "o[2] * 256 + o[3]", "65536", "65536", "ip", key), "p", "concat_ws('.', p.l div 256, p.l % 256, p.r div 256, p.r % 256)") + ")")
    area, rest = "cast(substr(m, 1, 3) as bigint)", "(cast(substr(m, 5, 2) as bigint) - 1) * 9999 + cast(substr(m, 8, 4) as bigint) - 1"
    valid = f"{area} between 1 and 899 and {area} <> 666 and substr(m, 5, 2) <> '00' and substr(m, 8, 4) <> '0000'"
    ssn = f"if({valid}, " + _let(feistel(f"{area} - if({area} < 666, 1, 2)", rest, "898", "989901", "ssn", key), "p", "concat(lpad(p.l + if(p.l < 665, 1, 2), 3, '0'), '-', lpad(p.r div 9999 + 1, 2, '0'), '-', lpad(p.r % 9999 + 1, 4, '0'))") + ", null)"
    day = "try_to_date(replace(m, '/', '-'), 'yyyy-MM-dd')"
    date = _let(day, "t", "if(t is null or year(t) not between 1800 and 2199, null, " + _let("datediff(t, date'1800-01-01')", "n", _let(feistel("n div 5411", "n % 5411", "27", "5411", "date", key), "p", "date_format(date_add(date'1800-01-01', cast(p.l * 5411 + p.r as int)), if(contains(m, '/'), 'yyyy/MM/dd', 'yyyy-MM-dd'))")) + ")")
    base, many = (lambda code: f"if({code} < 200, 0, 200)"), (lambda code: f"if({code} < 200, 200, 800)")
    moved = feistel(f"c.a - {base('c.a')}", f"(c.x - {base('c.x')}) * 10000 + c.n", many("c.a"), f"{many('c.x')} * 10000", "phone", key)
    phone = _let(f"concat(lpad(p.l + {base('c.a')}, 3, '0'), lpad(p.r div 10000 + {base('c.x')}, 3, '0'), lpad(p.r % 10000, 4, '0'))", "f", _refill("m", f"concat(left({only}, char_length({only}) - 10), f)"))
    codes = f"named_struct('a', cast(substr({ten}, 1, 3) as bigint), 'x', cast(substr({ten}, 4, 3) as bigint), 'n', cast(substr({ten}, 7) as bigint))"
    phone = _let(codes, "c", _let(moved, "p", phone))
    body = f"left({only}, char_length({only}) - 1)"
    card = f"if({_luhn(only, True)} % 10 <> 0, null, " + _let(digits(body, "card", key), "f", _refill("m", f"concat(f, pmod(-{_luhn('f', False)}, 10))")) + ")"
    email = f"concat(left(sha2(concat_ws('|', {_quoted(key)}, 'email', lower(m)), 256), 16), '@pii.invalid')"
    secret = f"left(concat(sha2(concat_ws('|', {_quoted(key)}, 'secret', lower(m)), 256), sha2(concat_ws('|', {_quoted(key)}, 'secret2', lower(m)), 256)), char_length(m))"
    return {"email": email, "ip": ip, "ssn": ssn, "date": date, "phone": phone, "card": card, "secret": secret}


#: The kind of a match from its form; the alternatives exclude one another, so the order decides nothing.
_KIND = r"""case when contains(m, '@') then 'email' when m rlike '^[0-9]{1,3}([.][0-9]{1,3}){3}$' then 'ip' when m rlike '^[0-9]{3}-[0-9]{2}-[0-9]{4}$' then 'ssn'
    when m rlike '^[0-9]{4}(-[0-9]{2}-|/[0-9]{2}/)[0-9]{2}$' then 'date' when before rlike '(?i:token|secret|key|password) ?[=:] ?\"$' then 'secret'
    when char_length(regexp_replace(m, '[^0-9]', '')) between 10 and 11 then 'phone' else 'card' end"""


def pseudonymise(docs: DataFrame, key: str | None = None, counts: bool = True) -> DataFrame:
    """``docs`` with pseudonyms in ``text`` and all other columns as they were; ``n_chars`` follows the text if it is there.

    ``key``: by default the session's (:func:`session_key`).
    ``counts`` adds one column per kind, ``n_<kind>``, in place of columns of these names.
    """
    key = key or session_key(docs.sparkSession)
    matches, gaps, found = (spare(docs, n) for n in ("_matches", "_gaps", "_found"))
    cases = " ".join(f"when '{k}' then {sql}" for k, sql in _pseudonyms(key).items())
    one = _let(_let(f"right(get({gaps}, j), 16)", "before", _KIND), "k", f"named_struct('kind', k, 'match', m, 'to', case k {cases} end)")
    df = docs.withColumn(matches, F.expr(f"if(text rlike {_quoted(CUE)}, regexp_extract_all(text, {_quoted(ANY)}, 0), cast(array() as array<string>))"))
    df = df.withColumn(gaps, F.expr(f"if(size({matches}) > 0, split(text, {_quoted(ANY)}, -1), array(text))"))
    df = df.withColumn(found, F.expr(f"if(size({matches}) > 0, transform({matches}, (m, j) -> {one}), null)"))
    for k in KINDS if counts else ():
        df = df.withColumn(f"n_{k}", F.expr(f"cast(coalesce(size(filter({found}, x -> x.kind = '{k}' and x.to is not null)), 0) as bigint)"))
    df = df.withColumn("text", F.expr(f"if({found} is null, text, concat({gaps}[0], array_join(transform({found}, (x, j) -> concat(coalesce(x.to, x.match), get({gaps}, j + 1))), '')))"))
    if "n_chars" in docs.columns:
        df = df.withColumn("n_chars", F.expr(f"if({found} is null, n_chars, cast(char_length(text) as bigint))").cast(docs.schema["n_chars"].dataType))
    return df.drop(matches, gaps, found)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return pseudonymise(docs).select("doc_id", "text", *(f"n_{k}" for k in KINDS))
