import base64
import hashlib
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers_llm import awkward, empty, words
from pyspark.sql import functions as F

from ledgerlens.llm import queries
from ledgerlens.llm.decontaminate import decontaminate
from ledgerlens.llm.hashed_features import collect_vectors
from ledgerlens.llm.langid import identify_languages, train_languages
from ledgerlens.llm.quality_rules import quality_rules, train_quality
from ledgerlens.llm.secret_scan import find_secrets, scan_secrets
from ledgerlens.llm.toxicity import score_toxicity
from ledgerlens.llm.unigram_tokens import UnigramCounter, count_tokens, read_vocabulary

SF_FULL = "/root/testdata/sf0.01"


def texts(spark, sf_dir):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


# decontamination ----------------------------------------------------------------------------------------------


def item_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [(m.group(), m.span()) for m in re.finditer(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)]


def brute_hits(docs, items):
    wanted = {}
    for i, t in items:
        w = [x for x, _ in item_words(t)]
        for k in range(max(1, len(w) - 9) if w else 0):
            wanted.setdefault(tuple(w[k : k + 10]), set()).add(i)
    sizes, out = {len(x) for x in wanted}, {}
    for d, t in docs:
        w = [x for x, _ in item_words(t)]
        hit, met = set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if owners := wanted.get(tuple(w[k : k + size])):
                    hit |= set(range(k, k + size))
                    met |= owners
        out[d] = (len(w), len(hit), len(met), hashlib.sha256(",".join(sorted(map(str, met))).encode()).hexdigest(), bool(hit))
    return out


def test_decontamination_equals_brute_force(spark):
    found = {r[0]: tuple(r)[1:] for r in queries.op4_benchmark_decontamination(spark, SF_FULL).collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{SF_FULL}/benchmark.parquet").select("item_id", "text").collect()]
    assert found == brute_hits(texts(spark, SF_FULL).items(), items)
    assert any(x[-1] for x in found.values())


def test_decontamination_in_blocks_and_offsets(spark):
    docs = awkward(spark, [(20, "Äh! One-TWO; and a null  ID has words", "", "", "")])
    items = spark.createDataFrame([(1, "one two"), (None, "ID has"), (3, None), (4, "…"), (5, "one two")], "item_id long, text string")
    whole = decontaminate(docs, items, width=2).collect()
    blocks = decontaminate(docs, items, width=2, pattern_bytes=10).collect()
    key = lambda rows: sorted((str(r["row"]["doc_id"]), r["n_words"], r["n_hit"], r["item_ids"], str(r["spans"])) for r in rows)
    assert key(whole) == key(blocks)
    r = next(r for r in whole if r["row"]["doc_id"] == 20)
    text = r["row"]["text"]
    assert (r["n_hit"], r["item_ids"]) == (4, [1, 5])
    assert [text[s["start"] : s["end"]] for s in r["spans"]] == ["One-TWO", "ID  has".replace("  ", " ")]
    assert decontaminate(empty(spark), items).count() == 0
    assert {r["n_hit"] for r in decontaminate(docs, items.where("false")).collect()} == {0}


def test_hostile_text_is_scanned_in_linear_time():
    """A megabyte of failing web tokens; hits in other letters do not hide a real one after them."""
    started = time.monotonic()
    assert find_secrets(b"eyJ" * 350_000) == []
    assert find_secrets(b"eyJa." * 200_000 + b"!") == []
    assert time.monotonic() - started < 3
    head = base64.urlsafe_b64encode(b'{"alg":"none"}').rstrip(b"=")
    token = head + b".e30.sig"
    assert find_secrets(b"xeyjeyj" + token) == [(7, 7 + len(token), "webtoken")]
    assert find_secrets(b"eyJbroken eyJ. " + token) == [(15, 15 + len(token), "webtoken")]


# secrets ------------------------------------------------------------------------------------------------------

BASE = {
    "assign": re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}
LEAST = {"assign": lambda m: len(m[2]) >= 6, "access": lambda m: len(m[0]) >= 20, "hex": lambda m: len(m[0]) >= 24}


def brute_base(text):
    kinds = list(BASE)
    found = [(m.start(), kinds.index(k), k, m.end()) for k in kinds for m in BASE[k].finditer(text or "") if LEAST[k](m)]
    return [(k, s, e) for s, _, k, e in sorted(found)]


def test_secrets_equal_brute_force(spark):
    found = queries.op8_secret_scans(spark, SF_FULL).collect()
    docs = texts(spark, SF_FULL)
    for r in found:
        base = brute_base(docs[r["doc_id"]])
        counts = Counter(k for k, _, _ in base)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(counts[k] for k in BASE)
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest()


@pytest.mark.parametrize(
    "text",
    [
        "é PassWord = 'abc.def-1' token:short secret=sixsix api_key: \"x\" apikey==abcdef",
        "AKIA" + "A" * 16 + " AKIAAKIA" + "1" * 12 + " AKIA" + "B" * 15,
        "0" * 24 + "g" + "f" * 23 + " " + "ab" * 40 + "ſecret=abcdefg tokentoken=abcdef",
        "token = token = abcdefghij, password=secret:abcdefgh",
    ],
)
def test_base_spans(text):
    data = text.encode()
    point = lambda b: len(data[:b].decode("utf-8", "ignore"))
    assert [(k, point(s), point(e)) for s, e, k in find_secrets(data)] == brute_base(text)


def test_checksums_and_mask(spark):
    body, digits, value = "A" * 30, "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", zlib.crc32(b"A" * 30)
    tail = ""
    while value:
        value, d = divmod(value, 62)
        tail = digits[d] + tail
    good, bad = f"ghp_{body}{tail.rjust(6, '0')}", f"ghp_{body}000000"
    rows = scan_secrets(awkward(spark, [(30, f"ü {good} {bad}", "", "", "")])).collect()
    r = next(r for r in rows if r["row"]["doc_id"] == 30)
    assert [s["kind"] for s in r["secrets"]] == ["forge"]
    assert r["masked_text"] == f"ü [secret] {bad}"
    assert next(r for r in rows if r["row"]["doc_id"] == 1)["masked_text"] is None
    assert len(rows) == 10 and scan_secrets(empty(spark)).count() == 0


# token counts -------------------------------------------------------------------------------------------------


def exact_tokenizer(vocabulary):
    from tokenizers import Tokenizer, models, pre_tokenizers

    unknown = [("<unk>", 0.0)] + [(f"<0x{b:02X}>", 0.0) for b in range(256)]
    t = Tokenizer(models.Unigram(unknown + vocabulary, unk_id=0, byte_fallback=True))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return t


def test_token_counts_equal_the_exact_tokenizer(spark, sf_dir):
    vocabulary = read_vocabulary(queries.VOCABULARY)
    exact, docs = exact_tokenizer(vocabulary), texts(spark, sf_dir)
    got = {r["doc_id"]: r["n_tokens"] for r in queries.op9_token_counts(spark, sf_dir).collect()}
    sample = [k for k in sorted(docs)][:60]
    assert {k: got[k] for k in sample} == {k: len(exact.encode(docs[k]).ids) for k in sample}


def test_token_ties_and_unknown():
    vocabulary = [("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁a", -2.0), ("ba", -3.0), ("▁▁", -1.5)]
    counter, exact = UnigramCounter(vocabulary), exact_tokenizer(vocabulary)
    for text in ("", "ab", "abab aab", " ab", "  a", "a日b", "日本", "a▁b", "xyz" * 40, "b" * 500, "a\nb "):
        assert counter.count(text) == (len(exact.encode(text).ids) if text else 0), text


def test_short_words_by_the_plain_loop():
    draw = random.Random(2)
    vocabulary = [(c, -draw.random()) for c in "▁abc"] + [("".join(draw.choices("abc", k=k)), -draw.randrange(1, 4) / 2) for k in (2, 2, 2, 3, 3, 4)]
    counter = UnigramCounter(vocabulary)
    asked, count_any = [], counter._count_any
    counter._count_any = lambda word: (asked.append(word), count_any(word))[1]
    words = ["".join(draw.choices("abc", k=draw.randrange(12))) for _ in range(500)]
    assert [counter.count("a " + w) - counter.count("a ") for w in words] == [count_any("▁" + w) - count_any("▁") for w in words]
    assert not asked and counter.count("ad") and counter.count("a" * 200) and asked == ["▁ad", "▁" + "a" * 200]


def test_an_empty_vocabulary_is_refused(spark):
    with pytest.raises(ValueError, match="no pieces"):
        count_tokens(awkward(spark), [])


def test_token_counts_of_awkward_rows(spark):
    rows = count_tokens(awkward(spark), [("▁", -1.0), ("o", -1.0)]).collect()
    assert sorted(r["n_tokens"] for r in rows if r["row"]["doc_id"] in (1, 2)) == [0, 0] and len(rows) == 9
    assert count_tokens(empty(spark), [("a", -1.0)]).count() == 0


# learned operators --------------------------------------------------------------------------------------------


def brute_quality(text):
    w = [m.group() for m in re.finditer(r"[^\x20\x09-\x0d]+", text or "")]
    runs = Counter(zip(w, w[1:], w[2:]))
    cover = {j for i in range(len(w) - 2) if runs[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(cover)


def test_quality_base_and_verdict(spark):
    rows = queries.op3_quality_rules(spark, SF_FULL).collect()
    docs = texts(spark, SF_FULL)
    for r in rows:
        base = brute_quality(docs[r["doc_id"]])
        assert tuple(r)[1:6] == base
        assert r["base_failed"] == (base[0] < 50 or 100 * base[4] > 50 * base[0])
        assert not (r["kept"] and r["base_failed"])
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_FULL}/labels.parquet").collect()}
    judged = [(r["kept"], truth[r["doc_id"]] == 1) for r in rows if r["doc_id"] in truth and not r["base_failed"]]
    assert sum(a == b for a, b in judged) / len(judged) > 0.95


def test_quality_awkward(spark):
    labels = spark.createDataFrame([(4, 1, 0), (6, 0, 1), (None, 1, 1), (5, None, None), (99, 1, 0)], "doc_id long, quality int, toxic int")
    docs = awkward(spark)
    rows = quality_rules(docs, train_quality(docs, labels)).collect()
    assert len(rows) == 9 and all(r["base_failed"] for r in rows if r["row"]["doc_id"] in (1, 2, 3, 4, 7))
    assert quality_rules(empty(spark), train_quality(empty(spark), labels.where("false"))).count() == 0


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = queries.op6_toxicity(spark, sf).where("held_out").join(labels, "doc_id").collect()
    toxic = [r["predicted"] for r in rows if r["toxic"] == 1]
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert sum(toxic) / len(toxic) > 0.85 and sum(clean) / len(clean) < 0.03


def test_toxicity_awkward(spark):
    labels = spark.createDataFrame([(4, 0), (6, 1), (None, 1), (5, None)], "doc_id long, toxic int")
    docs = awkward(spark)
    assert all(0 <= r["score"] <= 1 for r in score_toxicity(docs, docs, labels).collect())
    assert score_toxicity(empty(spark), docs, labels.where("false")).count() == 0


def test_languages_on_held_out_rows(spark):
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF_FULL}/documents.parquet").collect()}
    rows = queries.op7_language_id(spark, SF_FULL).where("held_out").collect()
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in rows) / len(rows) > 0.97


def test_languages_awkward(spark):
    docs = awkward(spark, [(40, "12 34 !!", "en", "", "")])
    model = train_languages(docs, F.lit(True))
    rows = {r["row"]["doc_id"]: (r["lang_pred"], r["score"]) for r in identify_languages(docs, model).collect()}
    assert [rows[i] for i in (1, 2, 3, 40)] == [("und", 0.0)] * 4
    assert rows[4][0] == "en" and rows[6][0] == "de"
    nothing = train_languages(empty(spark), F.lit(True))
    assert {r["lang_pred"] for r in identify_languages(docs, nothing).collect()} == {"und"}


def test_vectors_reach_the_driver_without_copies(spark):
    """8 MB of vectors, two of them of one id: they are views of what has come, in order of id, then of index."""
    rows = [(max(39 - i, 1), f"{i}", i % 2, 20) for i in range(40)]
    sample = spark.createDataFrame(rows, "doc_id long, text string, label int, of_class int")
    vector = lambda text: (np.arange(25_000) + int(text), np.full(25_000, int(text), np.float32))
    tracemalloc.start()
    try:
        found = collect_vectors(sample, vector)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 10e6  # 8 MB and a little
    order = lambda row: (row[0], int(row[1]))  # noqa: E731  the little-endian bytes of 38 and 39 are in their order
    assert len(found) == len(rows)
    for (doc_id, text, label, of_class), r in zip(sorted(rows, key=order), found):
        assert (r["doc_id"], r["label"], r["of_class"]) == (doc_id, label, of_class)
        index, value = r["vector"]
        assert index.dtype == np.int32 and value.dtype == np.float32
        assert (index == vector(text)[0]).all() and (value == vector(text)[1]).all()
    assert [len(x) for r in collect_vectors(sample.limit(1), lambda text: vector(text)[:0] + (np.empty(0, np.int64), np.empty(0))) for x in r["vector"]] == [0, 0]
    assert collect_vectors(sample.limit(0), vector) == []
