from collections import Counter, defaultdict

from segloom.llm.lines import drop_boilerplate, html_text, url_host
from pyspark.sql import functions as F

BLANK = " \t\r"


def brute(rows, ratio, least):
    pages, on = Counter(), defaultdict(Counter)
    split = [(site, None if text is None else text.split("\n")) for site, text in rows]
    for site, lines in split:
        pages[site] += 1
        for k in {x.strip(BLANK) for x in lines or ()} - {""}:
            on[site][k] += 1
    gone = {s: {k for k, n in c.items() if n >= least and n > pages[s] * ratio} for s, c in on.items()}
    out = []
    for site, lines in split:
        kept = None if lines is None else [x for x in lines if x.strip(BLANK) not in gone.get(site, set())]
        n = sum(bool(x.strip(BLANK)) for x in lines or ())
        out.append((site, None if kept is None else "\n".join(kept), n, 0 if kept is None else n - sum(bool(x.strip(BLANK)) for x in kept)))
    return sorted(out, key=repr)


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "site string, text string, n_lines string, _gone int, _page int")


def test_brute_force(spark):
    rows = [(f"s{i % 3}" if i % 11 else None, "\n".join([" menu ", f"line {i}", "" if i % 2 else "shared", "menu", f"f{i % 5}\t"])) for i in range(90)]
    rows += [("s1", None), ("s1", ""), ("s2", "\n \n"), ("s2", None), ("alone", "menu"), ("s0", "menu\nmenu"), ("s0", "menu\nmenu")]
    df = rows_of(spark, [(s, t, "x", 1, 2) for s, t in rows])
    for ratio, least in ((0.1, 10), (0.3, 3), (0.0, 1), (1.0, 1)):
        got = drop_boilerplate(df, "text", "site", ratio, least)
        assert got.columns == ["site", "text", "n_lines", "_gone", "_page", "n_dropped"]
        assert sorted([(r.site, r.text, r.n_lines, r.n_dropped) for r in got.collect()], key=repr) == brute(rows, ratio, least)


def test_hot_site(spark):
    rows = [("hot", f"same\nown {i}") for i in range(3000)] + [("other", "same\nown")] * 4
    got = drop_boilerplate(rows_of(spark, [(s, t, None, None, None) for s, t in rows]), "text", "site")
    assert {r.text for r in got.where("site = 'other'").collect()} == {"same\nown"}
    assert got.where("site = 'hot' AND n_dropped = 1 AND text LIKE 'own%'").count() == 3000


def test_small_sites(spark):
    """The ratio decides at any size; a line on a single page stays."""
    rows = [("three", f"menu\nown {i}") for i in range(3)] + [("one", "menu\nown")] + [("forty", ("menu\n" if i < 5 else "rare\n" if i < 9 else "") + f"own {i}") for i in range(40)]
    got = drop_boilerplate(rows_of(spark, [(s, t, None, None, None) for s, t in rows]), "text", "site").collect()
    for site, texts in (("three", ["own 0", "own 1", "own 2"]), ("one", ["menu\nown"])):
        assert sorted(r.text for r in got if r.site == site) == texts
    assert sum("menu" in r.text for r in got if r.site == "forty") == 0  # 5 pages of 40
    assert sum("rare" in r.text for r in got if r.site == "forty") == 4  # 4 pages of 40 are no more than a tenth


def test_copies_are_one_page(spark):
    """Copies of a text are no reason to drop its lines; lines of other texts of the site still go."""
    rows = [("s", "menu\ncopied one\ncopied two")] * 30 + [("s", f"menu\nown {i}") for i in range(70)]
    df = rows_of(spark, [(s, t, None, None, None) for s, t in rows])
    want = ["copied one\ncopied two"] * 30 + sorted(f"own {i}" for i in range(70))
    assert sorted(r.text for r in drop_boilerplate(df, "text", "site").collect()) == want
    each = drop_boilerplate(df, "text", "site", copies=True)
    assert sorted(r.text for r in each.collect()) == [""] * 30 + want[30:]


def test_empty(spark):
    assert drop_boilerplate(rows_of(spark, []), "text", "site").collect() == []


def test_html(spark):
    page = '<html><head><title>T</title><script>var t="</p>";</script></head><body><nav><ul><li>A</li></ul></nav><p class="x">b <b>c</b><br/>d</p><!-- <p>no</p> --></body></html>'
    df = spark.createDataFrame([(page, "https://User.Example.com:80/a?b"), (None, None), ("", "x")], "h string, u string")
    got = [tuple(r) for r in df.select(html_text(F.col("h")), url_host(F.col("u"))).collect()]
    assert got == [("A\nb c\nd", "user.example.com:80"), (None, None), ("", "")]
