"""Pseudonyms against a model in plain Python, round trips, and permutations that hit every value once."""

import datetime
import hashlib
import random
import re
from collections import Counter

import pytest
from tables import DATA

from tidemark.llm import pseudonyms as P

KEY = "a key for tests"
PRIVATE = [
    "call +1 (988) 555-2485 or (415) 555-2671, 415-555-2671 now, +44 100 555 1000, 015-155-1234 and (231) 155-0000",
    "card 4041894974608795 and 4111 1111 1111 1111, amex 378282246310005, 3782 822463 10005, 30569309025904",
    "4111 1111 1111 1111 12/27; 4111111111111111 123; 12 4111111111111111; 4111111111111111 7.51.17.173 card-4111111111111111 4111-1111-1111-1111 378282246310005",
    "at 10.0.0.1 or 255.255.255.255, ssn 123-45-6789 and 899-01-0001",
    "born 2001-02-03, 05/13/2001, 13/05/2001, 31/12/1999, 29/02/2004, 28.02.1999, 2099-12-31, 1900-01-01, 2000-02-29",
]
PLAIN = ["card 4041894974608796", "999.1.1.1 and 1.2.3.4.5", "000-12-3456 666-12-3456 900-12-3456", "2001-02-30 1899-12-31 31/02/2001", "version 3.14, 12 345", "", "no digits", "1990 1991 1992 1994 1995"]


def feistel(left, right, a, b, kind, key):
    for i in range(1, 9):
        f = lambda x: int(hashlib.sha256(f"{key}|{kind}|{i}|{x}".encode()).hexdigest()[:14], 16)  # noqa: B023, E731
        if i % 2:
            left = (left + f(right)) % a
        else:
            right = (right + f(left)) % b
    return left, right


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def refill(form, digits):
    it = iter(digits)
    return re.sub("[0-9]", lambda _: next(it), form)


def card(digits, key):
    h = (len(digits) - 1) // 2
    low = 2 * 10 ** (h - 1)
    left, right = feistel(int(digits[:h]) - low, int(digits[h:-1]), 5 * 10 ** (h - 1), 10 ** (len(digits) - 1 - h), "card", key)
    body = f"{left + low:0{h}d}{right:0{len(digits) - 1 - h}d}"
    return next(body + c for c in "0123456789" if luhn(body + c))


def sound(d):
    return 13 <= len(d) <= 19 and d[0] in "23456" and luhn(d)


def cards(run, key):
    groups = re.findall("[0-9]+[ -]?", run)
    bare = [x.strip(" -") for x in groups]
    sizes = [len(x) for x in bare]

    def fits(i):
        four = sizes[i : i + 4] == [4] * 4
        shapes = [4] * four + [3] * (sizes[i : i + 3] in ([4, 6, 4], [4, 6, 5])) + [1] * (13 <= sizes[i] <= 19) + [5] * (four and sizes[i + 4 : i + 5] in ([1], [2], [3]))
        return next((k for k in shapes if sound("".join(bare[i : i + k]))), 0)

    out, n, i = [], 0, 0
    while i < len(groups):
        k = fits(i)
        out.append(refill("".join(groups[i : i + k]), card("".join(bare[i : i + k]), key)) if k else groups[i])
        n, i = n + bool(k), i + max(k, 1)
    if not n and sound("".join(bare)):
        return refill(run, card("".join(bare), key)), 1
    return "".join(out), n


def days(late):
    first = datetime.date(1900, 1, 1)
    every = [first + datetime.timedelta(i) for i in range(73_049)]
    if late:
        return [d for d in every if d.day > 12 and (d.month, d.day) != (2, 29)] + [d for d in every if (d.month, d.day) == (2, 29)]
    return [d for d in every if d.day <= 12]


EARLY, LATE = days(False), days(True)
PLACE = {d: i for x in (EARLY, LATE) for i, d in enumerate(x)}


def day(d, key):
    i = PLACE[d]
    if d.day <= 12:
        left, right = feistel(i // 180, i % 180, 160, 180, "day", key)
        return EARLY[left * 180 + right]
    while True:
        left, right = feistel(i // 211, i % 211, 210, 211, "late", key)
        i = left * 211 + right
        if i < len(LATE):
            return LATE[i]


def ten(x, key):
    if re.match("[2-9]..[2-9]", x):
        left, right = feistel(int(x[:3]) - 200, int(x[3:]) - 2_000_000, 800, 8_000_000, "nanp", key)
        return f"{left + 200:03d}{right + 2_000_000:07d}"
    rank = int(x) if x[0] < "2" else 2 * 10**9 + (int(x[:3]) - 200) * 2_000_000 + int(x[3:])
    left, right = feistel(rank // 60_000, rank % 60_000, 60_000, 60_000, "ten", key)
    rank = left * 60_000 + right
    return f"{rank:010d}" if rank < 2 * 10**9 else f"{200 + (rank - 2 * 10**9) // 2_000_000:03d}{(rank - 2 * 10**9) % 2_000_000:07d}"


def date_of(y, m, d):
    try:
        got = datetime.date(int(y), int(m), int(d))
    except ValueError:
        return None
    return got if 1900 <= got.year <= 2099 else None


def replaced(m, key):
    """(pseudonym, kind, how many) of a match."""
    keyed = lambda kind, v: hashlib.sha256(f"{key}|{kind}|{v}".encode()).hexdigest()
    if "@" in m:
        return f"u{keyed('email', m.lower())[:12]}@d{keyed('domain', m.rpartition('@')[2].lower())[:8]}.example", "email", 1
    if re.fullmatch("[0-9A-Fa-f]{32,64}", m):
        if not re.search("[A-Fa-f]", m):
            return m, None, 0
        out = keyed("secret", m.lower())[: len(m)]
        return out.upper() if re.search("[A-F]", m) else out, "secret", 1
    if re.fullmatch(r"\d{1,3}(\.\d{1,3}){3}", m):
        o = list(map(int, m.split(".")))
        left, right = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, "ip", key)
        return f"{left // 256}.{left % 256}.{right // 256}.{right % 256}", "ip", 1
    if found := re.fullmatch(r"(\d{4})-(\d{2})-(\d{2})", m):
        d = date_of(*found.groups())
        return (day(d, key).strftime("%Y-%m-%d"), "date", 1) if d else (m, None, 0)
    if found := re.fullmatch(r"(\d{1,2})([/.])(\d{1,2})[/.](\d{4})", m):
        a, sep, b, y = found.groups()
        for form, d in (("%m/%d/%Y", date_of(y, a, b) if sep == "/" else None), (f"%d{sep}%m{sep}%Y", date_of(y, b, a))):
            if d:
                return day(d, key).strftime(form), "date", 1
        return m, None, 0
    digits = re.sub("[^0-9]", "", m)
    if re.fullmatch(r"\d{3}-\d{2}-\d{4}", m):
        area, group, serial = int(digits[:3]), int(digits[3:5]), int(digits[5:])
        if not (1 <= area <= 899 and area != 666 and group and serial):
            return m, None, 0
        left, right = feistel(area - (2 if area > 666 else 1), (group - 1) * 9999 + serial - 1, 898, 989_901, "ssn", key)
        return f"{left + (2 if left >= 665 else 1):03d}-{right // 9999 + 1:02d}-{right % 9999 + 1:04d}", "ssn", 1
    if m[0] in "+(" or re.fullmatch(r"\d{3}[.-]\d{3}[.-]\d{4}", m):
        return refill(m, digits[:-10] + ten(digits[-10:], key)), "phone", 1
    out, n = cards(m, key)
    return out, "card" if n else None, n


def model(text, key):
    if text is None:
        return None, Counter()
    counts = Counter()

    def one(m):
        out, kind, n = replaced(m[0], key)
        counts[kind] += n
        return out

    return re.sub(P.PATTERN, one, text, flags=re.ASCII), counts


def numbers(n, seed, forms=None):
    """Random numbers in every form (the first so many), valid or nearly."""
    rng = random.Random(seed)
    d = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    written = [
        lambda: f"+{rng.randrange(1, 999)} {d(3)} {d(3)} {d(4)}",
        lambda: f"({d(3)}) {d(3)}-{d(4)}",
        lambda: f"{d(3)}.{d(3)}.{d(4)}",
        lambda: f"{rng.randrange(1890, 2110)}-{rng.randrange(0, 14):02d}-{rng.randrange(0, 33):02d}",
        lambda: f"{rng.randrange(0, 33):02d}/{rng.randrange(0, 33):02d}/{rng.randrange(1899, 2101)}",
        lambda: f"{rng.randrange(1, 32):02d}.{rng.randrange(1, 13):02d}.{rng.randrange(1900, 2100)}",
        lambda: f"29/02/{rng.randrange(1900, 2100)}",
        lambda: f"{d(3)}-{d(2)}-{d(4)}",
        lambda: ".".join(str(rng.randrange(0, 260)) for _ in range(4)),
        lambda: (lambda x: next(x + c for c in "0123456789" if luhn(x + c)))(rng.choice("23456") + d(rng.randrange(11, 18))),
        lambda: f"{d(4)} {d(4)} {d(4)} {d(4)}",
        lambda: f"{d(4)}-{d(4)}-{d(4)}-{d(4)} {d(2)}",
    ]
    return [", ".join(rng.choice(written[:forms])() for _ in range(20)) for _ in range(n)]


def test_pseudonyms_against_a_model(frame):
    rows = list(enumerate([*PRIVATE, *PLAIN, *numbers(60, 1), None, "Ann.B@x.example.com and ann.b@X.example.com", "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"]))
    for r in P.pseudonymised(frame(rows), KEY).collect():
        text, counts = model(rows[r.doc_id][1], KEY)
        assert r.text == text
        assert {k: r[f"n_{k}"] for k in P.KINDS} == {k: counts[k] for k in P.KINDS} and r.n_replaced == sum(counts.values())


def test_documents_against_a_model(spark):
    docs = spark.read.parquet(str(DATA / "sf0.01/documents.parquet"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.text == model(texts[r.doc_id], P.DEMO_KEY)[0] for r in P.pseudonymised(docs).collect())


def test_numbers_come_back_with_the_key(frame):
    texts = [*PRIVATE, *numbers(150, 2, -1)]
    hidden = P.pseudonymised(frame(list(enumerate(texts))), "k1").select("doc_id", "text")
    back = [r.text for r in P.pseudonymised(hidden, "k1", forward=False).orderBy("doc_id").collect()]
    assert back == texts
    some = [r.text for r in hidden.orderBy("doc_id").collect()]
    other = [r.text for r in P.pseudonymised(frame(list(enumerate(texts))), "k2").orderBy("doc_id").collect()]
    assert all(a != b != c for a, b, c in zip(texts, some, other))
    for before, after in zip(PRIVATE, some):
        hide = lambda t: re.sub(r"\d", "9", re.sub(r"\d+(?:\.\d+){3}", "IP", t))
        assert hide(before) == hide(after)


def test_what_is_not_valid_stays(frame):
    out = P.pseudonymised(frame(list(enumerate(PLAIN)))).orderBy("doc_id").collect()
    assert [r.text for r in out] == PLAIN and sum(r.n_replaced for r in out) == 0


def test_one_day_has_one_pseudonym_in_every_form(frame):
    rows = [(0, "1985-12-25 12/25/1985 25/12/1985 25.12.1985"), (1, "2004-02-29 02/29/2004 29/02/2004 29.02.2004"), (2, "1985-05-06 05/06/1985 06.05.1985")]
    for r in P.pseudonymised(frame(rows), KEY).collect():
        iso, *rest = r.text.split()
        y, m, d = iso.split("-")
        assert rest == [x for x in (f"{m}/{d}/{y}", f"{d}/{m}/{y}", f"{d}.{m}.{y}") if r.doc_id != 2 or not x.startswith(f"{d}/")] and d != "25"


@pytest.mark.parametrize("late", [False, True])
def test_every_day_is_hit_once(frame, late):
    every = LATE if late else EARLY
    text = " ".join(d.strftime("%d.%m.%Y") for d in every)
    out = P.pseudonymised(frame([(1, text)]), KEY).first()
    assert sorted(out.text.split()) == sorted(text.split()) and out.n_date == len(every), "and a long text is read whole"


def test_permutation_is_onto(spark):
    """Over a small set, the network and the walk hit every value once."""
    with_key = spark.range(7 * 19).selectExpr("*", f"'key' as {P.KEY}")
    rows = with_key.selectExpr(f"{P._feistel('id div 19', 'id % 19', '7', '19', 'test', True)} q").selectExpr("q.l * 19 + q.r x").collect()
    assert sorted(r.x for r in rows) == list(range(7 * 19))
    for forward in (True, False):
        walked = with_key.filter("id < 101").selectExpr(f"{P._walked('id', 7, 19, 101, 'test', forward)} x").collect()
        assert sorted(r.x for r in walked) == list(range(101))


def test_telephone_numbers_do_not_meet(frame):
    """Valid and other numbers are permuted among themselves, so two never get one pseudonym."""
    rng = random.Random(3)
    numbers = sorted({f"{rng.randrange(10**10):010d}" for _ in range(3000)} | {f"{a}{b:03d}{d}{c:06d}" for a in "0129" for d in "0129" for b in (0, 99) for c in (0, 999_999)})
    text = " ".join(f"{x[:3]}-{x[3:6]}-{x[6:]}" for x in numbers)
    out = P.pseudonymised(frame([(1, text)]), KEY).first().text.replace("-", "").split()
    valid = lambda x: x[0] >= "2" and x[3] >= "2"
    assert len(set(out)) == len(numbers) and [valid(x) for x in out] == [valid(x) for x in numbers]


def test_key_is_in_no_plan(frame):
    shown = P.pseudonymised(frame([(1, "4041894974608795")]), "s3cret-of-ours")._jdf.queryExecution()
    assert "s3cret" not in shown.toString() and "s3cret" not in shown.explainString(_mode("extended"))


def _mode(name):
    from pyspark.sql import SparkSession

    return SparkSession.active().sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(name)


def test_edges(frame):
    rows = [(1, None), (2, ""), (3, PRIVATE[1]), (3, PRIVATE[1]), (None, "4041894974608795"), (4, "x " * 200_000 + "4041894974608795")]
    docs = frame(rows).selectExpr("*", "1 as found", "2 as made", f"3 as {P.KEY}", "4 as n_card", "5 as k")
    out = Counter((r.doc_id, r.n_card) for r in P.pseudonymised(docs).collect())
    assert out == Counter({(1, 0): 1, (2, 0): 1, (3, 5): 2, (None, 1): 1, (4, 1): 1})
    assert P.pseudonymised(frame([])).count() == 0
    shown = P.pseudonymised(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in shown and "Arrow" not in shown and "Join" not in shown
