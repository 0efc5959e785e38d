"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust their score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Java patterns. Possessive quantifiers and the look-behinds change no match: where a
# pattern fails at the start of a run of its first class it fails inside the run, too.
# They keep the search linear on long runs. \G lets a match start right after another.
_LOCAL = r"[A-Za-z0-9._%+-]"
_DIGITS = r"(?:(?<![0-9])|\G)[0-9]++"
_RUN = "[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}+"
#: Characters on either side in which context words are looked for.
NEAR = 40
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": rf"{_DIGITS}\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    # The match is where a code may begin; what may belong to it, and some more text, is looked ahead at.
    "iban": rf"(?<![A-Za-z0-9])(?=({_RUN}(?s:.{{0,{NEAR + 1}}})))[A-Z]{{2}}[0-9]{{2}}",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: Kinds of the base, in the order in which they are listed at one start, then those the method adds.
BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn")
KINDS = BASE + ADDED
#: A text without a match of this has no match of the kind; a cheap look before the search.
HINTS = {
    "email": "instr({t}, '@') > 0",
    "ip": r"{t} rlike '[0-9]\\.[0-9]'",
    "card": "{t} rlike '[0-9][ -]?[0-9]'",
    "phone": r"{t} rlike '\\+[0-9]'",
    "iban": "{t} rlike '[A-Z]{{2}}[0-9]{{2}}'",
    "ssn": "{t} rlike '[0-9]-[0-9]{{2}}-[0-9]'",
}
#: Score of a confirmed pattern, and what a context word nearby adds.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.3}
CONTEXT_SCORE = 0.3
#: Added spans count from this score on; those of the base always do.
LEAST_SCORE = 0.5
#: Characters of an account code by country.
CODE_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
CONTEXT = {
    "email": "mail|contact|write|kontakt|correo|courriel",
    "ip": "host|server|address|login|adresse",
    "card": "card|visa|credit|debit|karte|carte|tarjeta|pay",
    "phone": "call|phone|tel|fax|mobile|anruf",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "ssn": "ssn|social|security",
}


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _luhn(digits: str) -> str:
    """Whether a text of digits passes Luhn: from the right, every other digit is doubled."""
    digit = f"int(substr({digits}, length({digits}) - i, 1))"
    doubled = f"if(i % 2 = 1, {digit} * 2 - if({digit} > 4, 9, 0), {digit})"
    return f"aggregate(sequence(0, length({digits}) - 1), 0, (a, i) -> a + {doubled}) % 10 = 0"


def _mod97(code: str) -> str:
    """Whether an account code has remainder 1 by 97, its first four characters moved to the end, A = 10."""
    turned = f"concat(substr({code}, 5), substr({code}, 1, 4))"
    value = f"if(ascii(c) >= 65, a * 100 + ascii(c) - 55, a * 10 + ascii(c) - 48) % 97"
    return f"aggregate(split({turned}, ''), 0, (a, c) -> if(c = '', a, {value})) = 1"


def _code(m: str) -> str:
    """The account code at the start of a text, NULL without one.

    The code may end at any blank and where its run does. Ends with the remainder are
    taken in this order: the country's length, the longest.
    """
    run = f"split(regexp_extract({m}, {_quoted(f'^{_RUN}[A-Za-z0-9]?')}, 0), ' ')"
    ends = f"flatten(transform(array({run}), r -> transform(sequence(1, size(r)), k -> array_join(slice(r, 1, k), ' '))))"
    good = f"filter({ends}, p -> {_CODE} rlike '^[A-Z0-9]{{15,34}}$' AND {_mod97(_CODE)})"
    lengths = ", ".join(f"'{c}', {n}" for n, countries in CODE_LENGTHS.items() for c in countries.split())
    usual = f"filter(g, p -> length({_CODE}) <=> try_element_at(map({lengths}), left(p, 2)))"
    return f"transform(array({good}), g -> coalesce(get({usual}, 0), try_element_at(g, -1)))[0]"


_ONLY_DIGITS = "regexp_replace(m, '[^0-9]', '')"
_CODE = "replace(p, ' ', '')"
CONFIRMED = {
    "email": "true",
    "ip": r"forall(split(m, '\\.'), p -> length(ltrim('0', p)) <= 3 AND int(concat('0', right(ltrim('0', p), 3))) <= 255)",
    "card": f"length({_ONLY_DIGITS}) BETWEEN 14 AND 19 AND {_luhn(_ONLY_DIGITS)}",
    "phone": f"length({_ONLY_DIGITS}) BETWEEN 10 AND 15",
    "iban": "_iban_codes[i] IS NOT NULL",
    "ssn": "true",
}


def _spans(kind: str) -> str:
    """Confirmed spans of a kind with their scores, from the matches and the texts around them.

    A match begins after all texts and matches before it. Running sums are made in
    blocks of the square root's length: as many matches as there are, no array is
    summed anew for each of them.
    """
    found, around, lengths = f"_{kind}_found", f"_{kind}_around", f"_{kind}_lengths"
    block = f"int(ceil(sqrt(size({lengths}) + 1)))"
    base = (
        f"transform(sequence(0, {block}), b -> "
        f"aggregate(slice({lengths}, 1, b * {block}), 0, (a, x) -> a + x))"
    )
    number = KINDS.index(kind)
    head, length = f"{around}[i + 1].head", "length(m)"
    if kind == "iban":
        length = "length(_iban_codes[i])"
        head = f"lower(substr(m, {length} + 1, {NEAR}))"
    near = f"concat({around}[i].tail, ' ', {head})"
    score = (
        f"least(1.0D, {SCORES[kind]}D + if({near} rlike '{CONTEXT[kind]}', {CONTEXT_SCORE}D, 0.0D))"
    )
    start = (
        f"blocks[int(i div {block})] + aggregate(slice({lengths}, int(i div {block}) * {block} + 1, "
        f"i % {block}), 0, (a, x) -> a + x) + {around}[i].n"
    )
    spans = (
        f"flatten(transform(array({base}), blocks -> transform({found}, (m, i) -> "
        f"struct({start} AS `start`, {number} AS number, '{kind}' AS kind, "
        f"{start} + {length} AS `end`, {score} AS score, {CONFIRMED[kind]} AS good))))"
    )
    least = 0.0 if kind in BASE else LEAST_SCORE
    spans = f"filter({spans}, s -> s.good AND s.score >= {least}D)"
    if kind == "iban":
        # What looks like the begin of a code may be inside of one.
        spans = f"""
            aggregate({spans}, cast(array() AS array<struct<`start`: int, number: int, kind: string, `end`: int, score: double, good: boolean>>),
                (a, s) -> if(size(a) > 0 AND s.`start` < try_element_at(a, -1).`end`, a, concat(a, array(s))))
        """
    return f"if(size({found}) = 0, NULL, {spans})"


def find_private(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``spans``: structs of start, number, kind, end, score.

    Kinds are email, ip, card and phone (the base: leftmost matches, failing ones
    dropped), and iban (confirmed by remainder 97: the code may end at any blank, at
    its country's length if that passes, else the longest that does) and ssn (only
    where context words speak for it). Positions are code points, ends exclusive; spans are sorted by
    start, then kind as listed. Spans of different kinds may overlap.

    All expressions are built in: a text is split at the matches of a kind, and the
    lengths of what lies between give the positions. Cost is linear in the text.

    Defined cases: a NULL or empty text has no spans; every row is judged by itself,
    so repeated rows, NULL ids and empty tables need no rule. A column ``spans`` of
    ``docs`` is replaced.
    """
    # All that stays lies in one column, so that no name of a user's column is in the way.
    kept = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "spans"]).alias("_kept")
    t = "_text"
    # Steps of their own: each array is made once for a row.
    found = {
        f"_{k}_found": f"if({HINTS[k].format(t=t)}, regexp_extract_all({t}, {_quoted(p)}, {int(k == 'iban')}), array())"
        for k, p in PATTERNS.items()
    }
    pieces = "transform(split({t}, {p}, -1), p -> struct(length(p) AS n, lower(right(p, {n})) AS tail, lower(left(p, {n})) AS head))"
    around = {
        f"_{k}_around": f"if(size(_{k}_found) > 0, {pieces.format(t=t, p=_quoted(p), n=NEAR)}, NULL)"
        for k, p in PATTERNS.items()
    }
    around["_iban_codes"] = f"transform(_iban_found, m -> {_code('m')})"
    lengths = {
        f"_{k}_lengths": f"transform(_{k}_found, (m, i) -> {4 if k == 'iban' else 'length(m)'} + _{k}_around[i].n)"
        for k in PATTERNS
    }
    rows = docs.select(kept, F.col(f"`{text}`").alias("_text"))
    for step in (found, around, lengths):
        rows = rows.withColumns({c: F.expr(e) for c, e in step.items()})
    parts = ", ".join(f"coalesce({_spans(k)}, array())" for k in KINDS)
    spans = f"array_sort(transform(concat({parts}), s -> struct(s.`start`, s.number, s.kind, s.`end`, s.score)))"
    return rows.select("_kept.*", F.expr(spans).alias("spans"))


def span_list(spans: str, base_only: bool = False) -> Column:
    """Spans as kind:start:end, joined by commas."""
    which = f"filter({spans}, s -> s.number < {len(BASE)})" if base_only else spans
    return F.expr(f"array_join(transform({which}, s -> concat(s.kind, ':', s.`start`, ':', s.`end`)), ',')")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of personal data replaced by its kind in brackets.

    Overlapping spans become one, named after the first. ``n_chars``, if there is
    one, is the length of the new text; all other columns stay as they are, whatever
    their names. NULL texts stay NULL.
    """
    merged = """
        aggregate(spans, cast(array() AS array<struct<start: int, end: int, kind: string>>),
            (a, s) -> if(size(a) > 0 AND s.`start` < element_at(a, -1).`end`,
                concat(slice(a, 1, size(a) - 1), array(struct(element_at(a, -1).`start` AS `start`,
                    greatest(element_at(a, -1).`end`, s.`end`) AS `end`, element_at(a, -1).kind AS kind))),
                concat(a, array(struct(s.`start` AS `start`, s.`end` AS `end`, s.kind AS kind)))))
    """
    t = "text"
    pieces = f"""
        concat(array_join(transform(_merged, (s, i) -> concat(
            substr({t}, if(i = 0, 0, _merged[i - 1].`end`) + 1, s.`start` - if(i = 0, 0, _merged[i - 1].`end`)),
            '[', upper(s.kind), ']')), ''), substr({t}, element_at(_merged, -1).`end` + 1))
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    rows = find_private(docs.select(whole, F.col(f"`{text}`").alias("text"))).withColumn("_merged", F.expr(merged))
    masked = rows.withColumn("text", F.expr(f"if(size(spans) = 0, {t}, {pieces})"))
    new = {text: F.col("text")}
    if "n_chars" in docs.columns and text != "n_chars":
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return masked.select(*[new.get(c, F.col(f"whole.`{c}`")).alias(c) for c in docs.columns])
