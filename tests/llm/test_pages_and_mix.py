import io
import zipfile

import pytest
from compare import differences
from helpers_llm import awkward, empty
from pyspark.sql import functions as F

from ledgerlens.llm import queries
from ledgerlens.llm.html_extract import extract_text, page_blocks, suffix_groups
from ledgerlens.llm.mixing import mix
from ledgerlens.llm.zip_warc import ZipDirectory, read_packages, read_records, round_trip, write_packages
from ledgerlens.session import scratch_path

PAGE = "page_id long, url string, html string"


def article_of(source):
    return [text for text, zone in page_blocks(source) if zone >= 2]


@pytest.mark.parametrize(
    "source",
    [
        '<div class="layout with-sidebar"><article><p>x</p></article></div>',
        '<div id="page" class="no-comments"><main>x</main></div>',
        '<form id="aspnetForm"><input><article>x</article><button>go</button></form>',
        '<form><nav><article>menu</article></nav><main>x</main></form>',
        '<section class="related-posts"><article class="card">r</article></section><article>x</article>',
        '<article>x<div class="comment-list"><p>c</p></div><div class="share-buttons">s</div><div id=cookieBanner>c</div></article>',
        '<article>x<form><p>f</p></form></article>',
    ],
)
def test_names_and_forms_around_an_article(source):
    assert article_of(source) == ["x"]


def test_parts_of_an_article_stay():
    source = '<article><div class="entry-header"><h2>H</h2></div><p class="share-price">p</p><p title="a>q</p></article>'
    assert article_of(source) == ["H", "p", "q"]


def test_pages_with_extra_columns(spark):
    page = (1, "http://a/1", "<article>x</article>", "t", "o", 3)
    df = spark.createDataFrame([page, page], PAGE + ", text string, open string, row_key int")
    assert [tuple(r) for r in extract_text(df).collect()] == [(1, "http://a/1", "x")] * 2
MENU = "<div><span>home news sports weather travel food money cars jobs about us contact</span></div>"


def extracted(spark, rows):
    return {r["page_id"]: r["text"] for r in extract_text(spark.createDataFrame(rows, PAGE)).collect()}


def test_article_zone():
    html = """<html><head><title>T</title><style>p{}</style></head><body><header>Top</header><nav><ul><li>A</ul></nav>
    <div class="ad">Buy</div><article><header><h1>Head &amp; more</h1></header><p><b>One&nbsp; two<br>three<p>Four
    <aside>side</aside><section id="comments"><p>me too</p></section><form>f</form></article><footer>end</footer>
    <script>var t="</p>";</script>"""
    blocks = page_blocks(html)
    best = max(z for _, z in blocks)
    assert [t for t, z in blocks if z == best] == ["Head & more", "One two three", "Four"]


def test_declared_pages_of_the_table(spark, sf_dir):
    rows = queries.op1_html_extraction(spark, sf_dir).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        assert r["n_chars"] == len(r["text"]) > 0
        assert "©" not in r["text"] and "<p>" not in r["text"]
        assert r["text"].split("\n")[0][:5] in pages[r["page_id"]].replace("&amp;", "&")


def test_repeated_runs_go_and_unique_runs_stay(spark):
    rows = [(i, f"http://h.example/{i}", f"{MENU}<div>unique story number {i} " + " ".join(f"s{i}x{j}" for j in range(20)) + "</div>") for i in range(6)]
    rows.append((9, "http://other.example/", f"{MENU}<div>alone</div>"))
    found = extracted(spark, rows)
    assert all(found[i].startswith(f"unique story number {i} ") and "\n" not in found[i] for i in range(6))
    assert found[9].startswith("home news") and found[9].endswith("\nalone")


NOTICE = "this notice stands below every single story that we print here"


def story(i, k=40):
    return " ".join(f"s{i}x{j}" for j in range(k))


def test_host_array_judges_articles(spark):
    def page(i, host, text):
        return (i, f"http://{host}/{i}", f"<nav>menu</nav><article><h1>head {i}</h1><p>{text}</p><p>{NOTICE}</p></article>")

    rows = [page(i, "a.example", story(i)) for i in range(12)]  # a notice of one host
    rows += [page(20 + i, "few.example", story(20 + i)) for i in range(4)]  # too few pages to tell
    rows += [page(30 + i, "copies.example", story(30)) for i in range(9)]  # copies of one text stay
    quoted = [(40 + i, f"http://q.example/{i}", f"<article><p>{story(40 + i)}</p>" + (f"<p>{NOTICE}</p>" if i < 4 else "") + "</article>") for i in range(8)]
    rows += quoted + quoted[:3] * 5  # on most rows, but on four different articles
    df = spark.createDataFrame(rows, PAGE).repartition(5)
    found = {r["page_id"]: r["text"] for r in extract_text(df).collect()}
    assert extract_text(df).count() == len(rows)
    assert all(found[i] == f"head {i}\n{story(i)}" for i in range(12))
    assert all(found[i] == f"head {i}\n{story(i)}\n{NOTICE}" for i in range(20, 24))
    assert all(found[i] == f"head {i}\n{story(30)}\n{NOTICE}" for i in range(30, 39))
    assert all(found[i].split("\n")[1:] == ([NOTICE] if i < 44 else []) for i in range(40, 48))


def test_majority_runs_by_brute_force():
    import numpy as np

    from ledgerlens.llm.html_extract import _majority_runs
    from ledgerlens.llm.textkernel import windows

    draw = np.random.default_rng(3)
    hosts = [("a", "b", "c")[i % 3] for i in range(20)]
    streams = [draw.integers(10 * (i % 3), 10 * (i % 3) + 3, 40).astype(np.uint64) for i in range(20)]
    for depth in (2, 3, 4):
        runs, few = _majority_runs(hosts, streams, depth, 7)
        want = set()
        for host in "ab":
            sets = [set(windows(s, depth).tolist()) for h, s in zip(hosts, streams) if h == host]
            want |= {r for r in set().union(*sets) if 2 * sum(r in x for x in sets) > len(sets)}
        assert few == {"c"} and set(runs.tolist()) == want and len(runs) == len(want) > 0


def test_awkward_pages(spark):
    rows = [(1, None, None), (2, "http://[", ""), (3, "u", "<p>a &lt; b</p><p"), (4, "u", "plain"), (4, "u", "plain"), (None, "u", "<nav>x</nav>"), (5, "u", "<p>x " * 20_000)]
    got = extract_text(spark.createDataFrame(rows, PAGE)).collect()
    assert len(got) == 7
    found = {r["page_id"]: r["text"] for r in got}
    assert (found[1], found[2], found[4], found[None]) == ("", "", "plain", "")
    assert found[3].startswith("a < b")
    assert extract_text(spark.createDataFrame([], PAGE)).count() == 0


def test_suffix_groups_share_prefixes():
    import numpy as np

    tokens = np.random.default_rng(1).integers(0, 3, 300).astype(np.uint64)
    for depth in (1, 3, 5, 8):
        rank = suffix_groups(tokens, depth)
        parts = [tuple(tokens[i : i + depth]) for i in range(len(tokens) - depth + 1)]
        assert all((parts[i] == parts[j]) == (rank[i] == rank[j]) for i in range(len(parts)) for j in range(i))


# WARC ---------------------------------------------------------------------------------------------------------


def test_round_trip(spark):
    rows = [(1, "http://a/ü", "same"), (2, None, "same"), (3, "c", None), (4, "d", ""), (None, "e", "same"), (5, "f\r\nX: y", "ünï"), (5, "f", "others"), (6, "g", "x" * 300_000)]
    pages = spark.createDataFrame(rows, PAGE)
    manifest = write_packages(pages, scratch_path(spark, "warc"), package_bytes=10)
    assert manifest.agg(F.sum("records")).first()[0] == 8 and manifest.count() > 1
    found = read_packages(manifest).collect()
    assert len(found) == 8
    by = {(r["page_id"], r["payload_bytes"]): r for r in found}
    assert by[2, 4]["record_type"] == "response" and by[2, 4]["payload"] == "same"
    assert (by[1, 4]["refers_to"], by[None, 4]["refers_to"], by[3, 0]["refers_to"], by[4, 0]["record_type"]) == (2, 2, 4, "response")
    assert by[5, 5]["payload"] == "ünï" and by[6, 300_000]["payload"] == "x" * 300_000
    small = {r["page_id"]: r["record_type"] for r in round_trip(pages.where("page_id in (1, 2)"), min_bytes=5).collect()}
    assert small == {1: "response", 2: "response"}
    assert round_trip(pages.where("false")).count() == 0


def test_groups_too_many_to_broadcast(spark):
    rows = [(i, "u", ["", None, "same", f"own {i}"][i % 4]) for i in range(40)]
    rows += [(None, "n", "same"), (None, "n", ""), (39, "again", "own 39"), (7, "other", "same")]
    pages = spark.createDataFrame(rows, PAGE)
    found = [
        sorted(
            (str(r["page_id"]), r["payload_bytes"], str(r["refers_to"]))
            for r in read_packages(write_packages(pages, scratch_path(spark, "warc"), broadcast_groups=n)).collect()
        )
        for n in (50_000, 0)
    ]
    assert found[0] == found[1] and len(found[0]) == len(rows)
    assert sum(r[2] == "38" for r in found[0]) == 11 and ("None", 0, "37") in found[0]


def test_empty_pages_close_packages(spark):
    pages = spark.range(500).selectExpr("id as page_id", "cast(null as string) as url", "'' as html").coalesce(1)
    manifest = write_packages(pages, scratch_path(spark, "warc"), package_bytes=10_000)
    assert manifest.count() > 4 and read_packages(manifest).where("refers_to = 499").count() == 499


class Source(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def test_zip64_directory(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.writestr("a.txt", b"A" * 50)
        z.writestr("b.txt", b"B" * 60)
        z.comment = b"a comment"
    assert b"PK\x06\x06" in out.getvalue()
    d = ZipDirectory(Source(out.getvalue()))
    assert [d.read(*d.locate(n)) for n in ("a.txt", "b.txt")] == [b"A" * 50, b"B" * 60]
    with pytest.raises(ValueError):
        list(read_records(Source(b"not a zip")))


# mixing -------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_equal_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    assert differences(queries.QUERIES[name](spark, sf), sf, queries.ORACLE[name]) == []


def mixed(df, budget=1.0, **kw):
    out = mix(df, F.lit("all"), F.col("supply") * budget, {}, kw.pop("languages", {}), {}, text_col="text", **kw)
    return out.select("row.doc_id", "language", "n_tokens", "epoch").collect()


def test_shortage_goes_to_siblings_and_epochs_repeat(spark):
    rows = [(i, "w " * 10, "en" if i < 10 else "de", "s", None) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words string")
    got = mixed(df, languages={"en": 3.0, "de": 1.0}, max_epochs=2)
    taken = {x: sum(r["n_tokens"] for r in got if r["language"] == x) for x in ("en", "de")}
    assert taken == {"en": 200, "de": 200}
    assert {r["epoch"] for r in got if r["language"] == "en"} == {0, 1}
    assert len({(r["doc_id"], r["epoch"]) for r in got}) == len(got)


def test_given_tokens_count_instead_of_words(spark):
    rows = [(i, "w", "en", "s", str(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words string")
    got = mixed(df, max_epochs=1, tokens=F.col("n_words"))
    assert {r["doc_id"]: r["n_tokens"] for r in got} == {i: i for i in range(1, 10)}


def test_mixing_awkward(spark):
    got = mixed(awkward(spark), budget=1.0, max_epochs=1)
    assert sorted(str(r["doc_id"]) for r in got) == ["4", "5", "5", "6", "7", "None"]
    assert mixed(empty(spark)) == []
