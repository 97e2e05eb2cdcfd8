"""Text and date functions on literal cases, and against Python models of their meaning."""

import html
import re
import unicodedata
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates as D
from tidemark.functions import text as X


def run(spark, f, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.select("i", f("v").alias("o")).orderBy("i").select("o").collect()]


@pytest.mark.parametrize(
    ("f", "cases"),
    [
        (X.doc_slug, {"Slow Rivers, Deep Maps": "slow-rivers-deep-maps", "Q&A — Zoë: crème": "q-a-zoe-creme", "ab" * 90: "ab" * 40, "?": "doc", "straße": "strae", " -- Two  words -- ": "two-words"}),
        (X.channel_slug, {"Hello World": "hello-world", "Éa b": "a-b", "": "channel", "--": "channel"}),
        (X.title_of, {"Slow Rivers (Mira Okafor)": "Slow Rivers", "Maps (Atlas Series, 2) (J. Lind)": "Maps (Atlas Series, 2)", "No group here": "No group here", "(Only)": "(Only)", "A - (B) tail": "A"}),
        (X.author_of, {"Slow Rivers (Mira Okafor)": "Mira Okafor", "Maps (Atlas Series, 2) (J. Lind)": "J. Lind", "No group here": None, "( spaced )": "spaced"}),
        (X.clean_text, {"water-\nshed maps": "watershed maps\n", "half-open gate": "half-open gate\n", "x\n\n\n\ny\n\nz": "x\n\ny\n\nz\n", "del\u00adta": "delta\n", "p-\nq-\nr": "pq-\nr\n", " \t one\t\ttwo ": "one two\n"}),
        (X.word_count, {"a\u00a0b\x1cc": 3, "": 0, "  ": 0}),
        (X.is_page_number, {"MCM": True, "7": True, "0042": True, "10000": False, "livid": True, "p. 7": False, "": False}),
        (X.page_title, {"A - YouTube": "A", "A -YouTube\n": "A\n", "YouTube": "YouTube", "A - YouTube x": "A - YouTube x"}),
        (X.watched_title, {"Watched it": "it", "watched it": "watched it"}),
        (X.split_lines, {"a\r\nb\x0bc\u2028d\n": ["a", "b", "c", "d"], "": [], "\n": [""], "a\n\n": ["a", ""]}),
        (X.file_stem, {"a.en.srt": "a", "a": "a"}),
        (X.suffix, {"/x/A.PDF": ".pdf", ".txt": "", "a.b.c": ".c", "noext": ""}),
        (D.locale_stamp, {"3 Feb 2025, 09:05:07 CET": "2025-02-03T09:05:07", "February 3, 2025, 9:05:07\u202fPM CET": "2025-02-03T21:05:07", "Jun 30, 2024, 12:15:00 PM": "2024-06-30T12:15:00", "Jun 30, 2024, 12:15:00 AM": "2024-06-30T00:15:00", "3 Foo 2025, 09:05:07 Feb 3, 2025, 9:05:07 PM": None, "none": None}),
    ],
)
def test_cases(spark, f, cases):
    assert run(spark, f, list(cases)) == list(cases.values())


def test_iso_day_like_python(spark):
    def model(s):
        try:
            return datetime.fromisoformat(s.replace("Z", "+00:00")).date()
        except ValueError:
            return None

    values = ["2026-08-10", "20260810", "2026-08-45T01:02:03", "2026-08", "2026-08-10Tgarbage", "2026-08-10T23:30:00+09:30", "2026-08-10T23:30", "2026-08-10 23:30:00.123Z", "2026-08-10T24:30:00", "2026-02-30", "2024-02-29T01", "2026-08-10T", "x"]
    assert run(spark, D.iso_day, values) == [model(v) for v in values]


def test_strip_and_spaces_like_python(spark):
    values = ["  a b\x1c", "\x1fx\x85", " ", " a  b "]
    assert run(spark, X.strip, values) == [v.strip() for v in values]
    assert run(spark, X.word_count, values) == [len(v.split()) for v in values]


def test_unescape_and_decomposition_like_python(spark):
    values = ["a &amp; b", "&eacute;&#39;&lt;i&gt;", "plain", "&notanentity;", None]
    assert run(spark, X.unescape_html, values) == [html.unescape(v) if v is not None else None for v in values]
    names = ["œuvre ﬁn", "Ｆｕｌｌ", "naïve"]
    fold = [unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode().lower().replace(" ", "-") for v in names]
    assert run(spark, X.doc_slug, names) == fold


def test_patterns_in_the_python_dialect(spark):
    df = spark.createDataFrame([("Foo foo",), ("BAR",), ("",)], "t string")
    rows = [r for r in df.select(X.searches("t", r"(?P<a_b>foo) (?P=a_b)"), X.searches("t", r"b(?:a)r\Z"), X.searches("t", "x*"), X.searches("t", r"(f)?(?(1)oo|ar)")).collect()]
    assert [tuple(r) for r in rows] == [(True, False, True, True), (False, True, True, True), (False, False, True, False)]
    with pytest.raises(Exception):
        X.java_pattern("(")


@pytest.mark.filterwarnings("ignore::FutureWarning")
@pytest.mark.parametrize("pattern", [r"[a&&b]c", r"[[x]y", r"[]a]b", r"[^]a]b", r"[a[]c", r"(?P<a_b>x)(?P<ab>y)(?P=a_b)(?P=ab)", r"(?x) a b # c", r"a$", r"^b", r"x.y", r"[\]\[]q", r"\bé", r"[\w&&]{2}"])
def test_patterns_find_what_python_finds(spark, pattern):
    texts = ["&c", "ac", "bc", "[y", "xy", "]b", "ab", "cb", "[c", "xyxy", "xyyx", "a", "a\n", "a\r", "a\u2028", "c\nb", "c\rb", "x\ry", "x\ny", "x\u0085y", "[q", "]q", "É", "&&", "A&"]
    assert run(spark, lambda c: X.searches(c, pattern), texts) == [re.search(pattern, t, re.IGNORECASE) is not None for t in texts]


def test_epochs(spark):
    row = spark.range(1).select(D.from_epoch_1601(F.lit(13_348_540_800_000_000)), D.from_epoch_1970(F.lit(1_704_067_200_000_000)), D.visited_at(D.from_epoch_1601(F.lit(0)))).first()
    assert tuple(row) == ("2024-01-01 00:00:00", "2024-01-01 00:00:00", None)
