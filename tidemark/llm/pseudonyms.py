"""Private data as format-preserving pseudonyms, with DataFrame functions alone.

Validated numbers and dates are permuted by a keyed Feistel network over exactly the set of valid values of their
format, so a value stays valid and gets the same other value wherever it occurs with that key; `forward=False`
undoes it (days and months come back with two digits). The network alternates between two counters of sizes A and B
whose product is the size of the set: a counter gets a keyed hash of the other added, modulo its size, for `ROUNDS`
rounds. Where the set has no such factors the counters are a little larger, and the network is applied again while its
value lies outside the set; `outside` bounds the times, so the walk always ends inside.

Kinds, and the sets that are permuted:

* payment cards: numbers of 13 to 19 digits that start with 2 to 6 and pass the Luhn check; the check digit is made
  anew. In a run of digit groups the groups are tried from the left in the sizes that cards are written in (one group,
  4-4-4-4 with up to three more digits, 4-6-5, 4-6-4); if none is a card, the whole run is tried. A run ends where an
  address, date, telephone or social security number starts. A card of 17 to 19 digits written in groups does not come
  back where the first 16 digits of its pseudonym pass as a card by chance (1 in 10).
* telephone numbers of ten digits with country code or in a written form: those with a valid area and exchange (2 to 9
  first) among themselves, all others among themselves. The country code stays.
* IPv4 addresses; social security numbers (valid areas, groups, serials).
* dates of 1900 to 2099 (y-m-d; m/d/y, else d/m/y; d.m.y): days up to 12 among themselves, days above 12 among
  themselves, so that every form keeps its reading and one day has one pseudonym in all forms.

E-mail addresses and hexadecimal secrets of 32 to 64 digits are no numbers: they get one-way keyed pseudonyms of their
form, equal for equal values. A number that fails its validation is not such a number and stays. Texts without a digit
or an at sign are passed through at once.

The key comes from a one-row frame by a scalar subquery, so it stands in no plan, event log or user interface.

A null text stays null with no replacements; an empty one stays empty. Texts are read whole, whatever their length.
Every row returns once, repeated rows as often as they come, null ids too; an empty table gives an empty result. Columns
other than doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Stands in where no key is given; it is public, so a production run passes its own secret.
DEMO_KEY = "tidemark demonstration key"
KINDS = ("email", "secret", "ip", "date", "ssn", "phone", "card")
#: The column that holds the key inside expressions.
KEY = "__tm_key"

# The written forms that are looked for, in order of precedence.
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_IP = rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)"
_DATE = r"(?<![\d/.\-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![\d/]|[.\-]\d)"
_SSN = r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])"
_PHONE = r"(?<![\d\-])\d{3}[.\-]\d{3}[.\-]\d{4}(?![\d\-])"
_FORMS = (
    r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)+",
    r"(?<![A-Za-z0-9])[0-9A-Fa-f]{32,64}(?![A-Za-z0-9])",
    _IP,
    _DATE,
    _SSN,
    r"\+\d{1,3}[ .\-]?(?:\(\d{3}\)|\d{3})[ .\-]?\d{3}[ .\-]?\d{4}(?!\d)",
    r"(?<!\d)\(\d{3}\) ?\d{3}[ .\-]\d{4}(?!\d)",
    _PHONE,
    rf"(?<!\d)\d(?:\d|[ \-](?!{_IP}|{_DATE}|{_SSN}|{_PHONE})\d){{12,}}+",
)
PATTERN = "|".join(_FORMS)


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _feistel(left: str, right: str, a: str, b: str, kind: str, forward: bool) -> str:
    """SQL of struct(l, r) after the rounds; left < a and right < b are SQL of long values."""
    f = f"cast(conv(substr(sha2(concat({KEY}, {_sql('|' + kind + '|')}, i, '|', %s), 256), 1, 14), 16, 10) as bigint)"
    steps, sign = (f"sequence(1, {ROUNDS})", "+") if forward else (f"sequence({ROUNDS}, 1, -1)", "-")
    return (
        f"aggregate({steps}, named_struct('l', cast({left} as bigint), 'r', cast({right} as bigint)), (s, i) -> "
        f"if(i % 2 = 1, named_struct('l', pmod(s.l {sign} {f % 's.r'}, cast({a} as bigint)), 'r', s.r), named_struct('l', s.l, 'r', pmod(s.r {sign} {f % 's.l'}, cast({b} as bigint)))))"
    )


def _walked(index: str, a: int, b: int, size: int, kind: str, forward: bool) -> str:
    """SQL of the permuted index of a set of `size` values, at most a * b; of the latter, a * b - size lie outside."""
    again = _feistel(f"w div {b}", f"w % {b}", str(a), str(b), kind, forward)
    once = _with(again, "q", f"q.l * {b} + q.r")
    return f"aggregate(sequence(0, {a * b - size}), cast(-1 as bigint), (v, k) -> if(v between 0 and {size - 1}, v, {_with(f'if(k = 0, {index}, v)', 'w', once)}))"


def _luhn(digits: str, odd: int) -> str:
    """SQL of the Luhn sum; odd: whether the last digit counts once (1) or twice (0)."""
    d = f"cast(substr({digits}, -k, 1) as int)"
    return f"aggregate(sequence(1, length({digits})), 0, (t, k) -> t + if(k % 2 = {odd}, {d}, {d} * 2 - if({d} > 4, 9, 0)))"


def _refill(form: str, digits: str) -> str:
    """SQL of a written form whose digits are replaced in turn."""
    return f"aggregate(split({form}, ''), named_struct('k', 1, 'o', ''), (u, c) -> if(c rlike '[0-9]', named_struct('k', u.k + 1, 'o', concat(u.o, substr({digits}, u.k, 1))), named_struct('k', u.k, 'o', concat(u.o, c))), u -> u.o)"


def _pad(x: str, n) -> str:
    return f"lpad(cast({x} as string), {n}, '0')"


def _with(values: str, name: str, body: str) -> str:
    """SQL of body with a name for a value, computed once."""
    return f"transform(array({values}), {name} -> {body})[0]"


def _card(digits: str, forward: bool) -> str:
    """SQL of a card's digits, permuted, with its check digit."""
    h = f"(length({digits}) - 1) div 2"
    g = f"(length({digits}) - 1 - {h})"
    lowest = f"cast(2 * pow(10, {h} - 1) as bigint)"
    both = _feistel(f"cast(substr({digits}, 1, {h}) as bigint) - {lowest}", f"substr({digits}, 1 + {h}, {g})", f"5 * pow(10, {h} - 1)", f"pow(10, {g})", "card", forward)
    return _with(_with(both, "q", f"concat({_pad(f'q.l + {lowest}', h)}, {_pad('q.r', g)})"), "p", f"concat(p, pmod(10 - {_luhn('p', 0)} % 10, 10))")


def _cards(m: str, forward: bool) -> str:
    """SQL of struct(kind, value, n) for a run of digit groups: its cards permuted, the rest as it is."""

    def text(first: str, many: str, of: str = "t") -> str:
        return f"array_join(slice({of}, {first} + 1, {many}), '')"

    def sound(digits: str) -> str:
        return f"substr({digits}, 1, 1) between '2' and '6' and {_luhn(digits, 1)} % 10 = 0"

    size = [f"coalesce(length(get(g, i + {k})), 0)" for k in range(5)]
    fours = " and ".join(f"{x} = 4" for x in size[:4])
    shapes = f"array(if({fours}, 4, 0), if({size[0]} = 4 and {size[1]} = 6 and {size[2]} in (4, 5), 3, 0), if({size[0]} between 13 and 19, 1, 0), if({fours} and {size[4]} between 1 and 3, 5, 0))"
    fits = f"filter({shapes}, k -> k > 0 and {_with(text('i', 'k', 'g'), 'd', sound('d'))})"
    add = f"named_struct('after', i + k[0], 'w', concat(s.w, array(named_struct('a', i, 'b', i + k[0]))))"
    none = "cast(array() as array<struct<a: int, b: int>>)"
    found = f"aggregate(sequence(0, size(g) - 1), named_struct('after', 0, 'w', {none}), (s, i) -> if(i < s.after, s, {_with(fits, 'k', f'if(size(k) > 0, {add}, s)')}), s -> s.w)"
    whole = f"if(size(w) = 0 and length(array_join(g, '')) between 13 and 19 and {_with(text('0', 'size(g)', 'g'), 'd', sound('d'))}, array(named_struct('a', 0, 'b', size(g))), w)"
    card = _with(text("c.a", "c.b - c.a"), "form", _with(_with(text("c.a", "c.b - c.a", "g"), "d", _card("d", forward)), "z", _refill("form", "z")))
    before = "if(j = 0, 0, c0[j - 1].b)"
    pieces = f"concat(array_join(transform(c0, (c, j) -> concat({text(before, f'c.a - {before}')}, {card})), ''), {text('c0[size(c0) - 1].b', 'size(t)')})"
    value = f"if(size(c0) = 0, named_struct('kind', cast(null as string), 'value', {m}, 'n', 0), named_struct('kind', 'card', 'value', {pieces}, 'n', size(c0)))"
    return _with(f"regexp_extract_all({m}, '[0-9]+[ -]?', 0)", "t", _with("transform(t, x -> regexp_replace(x, '[ -]', ''))", "g", _with(_with(found, "w", whole), "c0", value)))


#: Days above 12 of a month that stand before each month's own in a year, 29 February aside: a fixed value.
_BEFORE = "array(0, 19, 35, 54, 72, 91, 109, 128, 147, 165, 184, 202)"


def _day(year: str, month: str, day: str, form: str, forward: bool) -> str:
    """SQL of a date's pseudonym; days up to 12 and days above 12 (29 February last) are two sets."""
    low = _with(_feistel(f"(({year} - 1900) * 12 + {month} - 1) div 15", f"(({year} - 1900) * 12 + {month} - 1) % 15 * 12 + {day} - 1", "160", "180", "day", forward), "q", "named_struct('y', 1900 + (q.l * 15 + q.r div 12) div 12, 'm', (q.l * 15 + q.r div 12) % 12 + 1, 'd', q.r % 12 + 1)")
    index = f"if({month} = 2 and {day} = 29, 44200 + ({year} - 1904) div 4, ({year} - 1900) * 221 + element_at({_BEFORE}, cast({month} as int)) + {day} - 13)"
    slot = _with(f"size(filter({_BEFORE}, o -> o <= u % 221))", "mm", f"named_struct('y', 1900 + u div 221, 'm', cast(mm as bigint), 'd', u % 221 - element_at({_BEFORE}, mm) + 13)")
    high = _with(_walked(index, 210, 211, 44249, "late", forward), "u", f"if(u >= 44200, named_struct('y', 1904 + (u - 44200) * 4, 'm', cast(2 as bigint), 'd', cast(29 as bigint)), {slot})")
    parts = {"y": _pad("t.y", 4), "m": _pad("t.m", 2), "d": _pad("t.d", 2)}
    written = f"concat({', '.join(parts[c] if c in parts else _sql(c) for c in form)})"
    return _with(f"if({day} <= 12, {low}, {high})", "t", written)


def replacement(m: str, forward: bool = True) -> str:
    """SQL of struct(kind, value, n) for the SQL of a match; kind is null for what is not valid. `KEY` is a column."""
    digits = f"regexp_replace({m}, '[^0-9]', '')"

    def fe(left, right, a, b, kind):
        return _feistel(left, right, a, b, kind, forward)

    def as_kind(kind, value):
        return f"named_struct('kind', '{kind}', 'value', {value}, 'n', 1)"

    left_alone = f"named_struct('kind', cast(null as string), 'value', {m}, 'n', 0)"

    def keyed(kind, value):
        return f"sha2(concat({KEY}, '|{kind}|', {value}), 256)"

    email = f"concat('u', substr({keyed('email', f'lower({m})')}, 1, 12), '@d', substr({keyed('domain', f'lower(substring_index({m}, {_sql("@")}, -1))')}, 1, 8), '.example')"
    secret = f"if({m} rlike '[A-F]', upper(substr({keyed('secret', f'lower({m})')}, 1, length({m}))), substr({keyed('secret', f'lower({m})')}, 1, length({m})))"
    o = [f"cast(split({m}, '[.]')[{i}] as bigint)" for i in range(4)]
    ip = _with(fe(f"{o[0]} * 256 + {o[1]}", f"{o[2]} * 256 + {o[3]}", "65536", "65536", "ip"), "q", "concat_ws('.', q.l div 256, q.l % 256, q.r div 256, q.r % 256)")
    area, group, serial = (f"cast(substr({digits}, {i}, {n}) as int)" for i, n in ((1, 3), (4, 2), (6, 4)))
    ssn = _with(
        fe(f"{area} - if({area} > 666, 2, 1)", f"({group} - 1) * 9999 + {serial} - 1", "898", "989901", "ssn"),
        "q",
        f"concat({_pad('q.l + if(q.l >= 665, 2, 1)', 3)}, '-', {_pad('q.r div 9999 + 1', 2)}, '-', {_pad('q.r % 9999 + 1', 4)})",
    )
    ten = f"right({digits}, 10)"
    nanp = f"{ten} rlike '^[2-9][0-9]{{2}}[2-9]'"
    code = f"left({digits}, length({digits}) - 10)"
    first, fourth, whole = f"cast(left({ten}, 1) as bigint)", f"cast(substr({ten}, 4, 1) as bigint)", f"cast({ten} as bigint)"
    # all others: first digit 0 or 1 (2 * 10^9 values), then first digit 2 to 9 and fourth digit 0 or 1 (1.6 * 10^9)
    rank = f"if({first} < 2, {whole}, 2000000000 + cast(substr({ten}, 1, 3) as bigint) * 2000000 - 400000000 + {fourth} * 1000000 + cast(substr({ten}, 5) as bigint))"
    other = _with(
        rank,
        "v",
        _with(
            _with(fe("v div 60000", "v % 60000", "60000", "60000", "ten"), "q", "q.l * 60000 + q.r"),
            "u",
            f"if(u < 2000000000, {_pad('u', 10)}, concat({_pad('200 + (u - 2000000000) div 2000000', 3)}, {_pad('(u - 2000000000) % 2000000', 7)}))",
        ),
    )
    valid_ten = _with(fe(f"cast(substr({ten}, 1, 3) as int) - 200", f"cast(substr({ten}, 4) as int) - 2000000", "800", "8000000", "nanp"), "q", f"concat({_pad('q.l + 200', 3)}, {_pad('q.r + 2000000', 7)})")
    phone = _refill(m, f"concat({code}, if({nanp}, {valid_ten}, {other}))")
    part = [f"regexp_extract({m}, '^([0-9]+)[-/.]([0-9]+)[-/.]([0-9]+)$', {i})" for i in (1, 2, 3)]

    def valid(year, month, dayno):
        return f"{year} between 1900 and 2099 and {month} between 1 and 12 and {dayno} between 1 and 31 and try_cast(concat({_pad(year, 4)}, '-', {_pad(month, 2)}, '-', {_pad(dayno, 2)}) as date) is not null"

    p1, p2, p3 = (f"cast({x} as int)" for x in part)
    slash = f"{m} like '%/%'"
    date = (
        f"case when {m} like '%-%' then if({valid(p1, p2, p3)}, {as_kind('date', _day(p1, p2, p3, 'y-m-d', forward))}, {left_alone}) "
        f"when {slash} and {valid(p3, p1, p2)} then {as_kind('date', _day(p3, p1, p2, 'm/d/y', forward))} "
        f"when {slash} and {valid(p3, p2, p1)} then {as_kind('date', _day(p3, p2, p1, 'd/m/y', forward))} "
        f"when not {slash} and {valid(p3, p2, p1)} then {as_kind('date', _day(p3, p2, p1, 'd.m.y', forward))} else {left_alone} end"
    )
    return (
        f"case when {m} like '%@%' then {as_kind('email', email)} "
        f"when {m} rlike '^[0-9A-Fa-f]{{32,64}}$' then if({m} rlike '[A-Fa-f]', {as_kind('secret', secret)}, {left_alone}) "
        f"when {m} rlike '^[0-9]{{1,3}}([.][0-9]{{1,3}}){{3}}$' then {as_kind('ip', ip)} "
        f"when {m} rlike '^([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{1,2}}([/.])[0-9]{{1,2}}[/.][0-9]{{4}})$' then {date} "
        f"when {m} rlike '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$' then if({area} between 1 and 899 and {area} <> 666 and {group} > 0 and {serial} > 0, {as_kind('ssn', ssn)}, {left_alone}) "
        f"when {m} like '+%' or {m} like '(%' or {m} rlike '^[0-9]{{3}}[.-][0-9]{{3}}[.-][0-9]{{4}}$' then {as_kind('phone', phone)} "
        f"else {_cards(m, forward)} end"
    )


def pseudonymised(docs: DataFrame, key: str = DEMO_KEY, forward: bool = True) -> DataFrame:
    """doc_id, text with pseudonyms, n_<kind> for each kind, n_replaced."""
    p = _sql(PATTERN)
    secret = docs.sparkSession.sql("VALUES (:k)", args={"k": key}).toDF(KEY).scalar()
    found = docs.select("doc_id", "text", secret.alias(KEY)).selectExpr("*", f"if(text rlike '[0-9@]', regexp_extract_all(text, {p}, 0), cast(array() as array<string>)) found")
    made = found.withColumn("made", F.expr(f"transform(found, m -> {replacement('m', forward)})"))
    joined = f"if(size(found) > 0, concat_ws('', flatten(zip_with(split(text, {p}, -1), made, (gap, x) -> array(gap, x.value)))), text)"
    counts = [f"cast(coalesce(aggregate(filter(made, x -> x.kind = '{k}'), 0, (t, x) -> t + x.n), 0) as bigint) n_{k}" for k in KINDS]
    return made.selectExpr("cast(doc_id as long) doc_id", f"{joined} text", *counts, "cast(coalesce(aggregate(made, 0, (t, x) -> t + x.n), 0) as bigint) n_replaced")
