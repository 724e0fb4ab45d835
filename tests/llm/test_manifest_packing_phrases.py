import hashlib
import random
import re
import zlib
from bisect import bisect_left, insort
from collections import Counter
from pathlib import Path

import pytest
from compare import differences
from helpers_llm import awkward, empty
from pyspark.sql import functions as F

from ledgerlens.llm import collocations, packing, queries
from ledgerlens.llm.collocations import mine_collocations
from ledgerlens.llm.merkle import merkle_manifest
from ledgerlens.llm.packing import WordEncoder, best_fit_decreasing, pack_documents, sequences

SF = "/root/testdata/sf0.001"

# manifest -----------------------------------------------------------------------------------------------------

DOCS = "doc_id long, source string, lang string, n_chars long, text string, leaf string, root string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tag(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(nodes, fanout):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + fanout])) for i in range(0, len(out[-1]), fanout)])
    return out


def siblings(tree, place, fanout):
    found = ""
    for level in tree[:-1]:
        start = place - place % fanout
        found += "".join(d for i, d in enumerate(level[start : start + fanout], start) if i != place)
        place //= fanout
    return found


def brute_manifest(rows, fanout):
    branches = {}
    for r in rows:
        branches.setdefault(r[2], []).append((r[0], h("".join(map(tag, r[:5])))))
    order = sorted(branches, key=lambda b: (b is not None, (b or "").encode()))
    trees = {}
    for b in order:
        branches[b].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[b] = levels([leaf for _, leaf in branches[b]], fanout)
    top = levels([trees[b][-1][0] for b in order], fanout)
    return Counter(
        (i, leaf, trees[b][-1][0], top[-1][0], siblings(trees[b], place, fanout) + siblings(top, n, fanout))
        for n, b in enumerate(order)
        for place, (i, leaf) in enumerate(branches[b])
    )


def manifest_rows(spark, seed, size):
    rng = random.Random(seed)
    langs = [None, "", "en", "-", "é", "zz"]
    rows = [(i, f"s{i % 3}", rng.choice(langs), i, f"text {i} ü", "x", "y") for i in range(size)]
    return [*rows, (None, None, "en", None, None, None, None), (3, "again", "en", 1, "other", "x", "y"), (3, "again", "en", 1, "other", "x", "y")]


@pytest.mark.parametrize(("fanout", "size"), [(2, 700), (3, 40), (2, 1)])
def test_manifest_equals_brute_force(spark, fanout, size):
    rows = manifest_rows(spark, size, size)
    got = merkle_manifest(spark.createDataFrame(rows, DOCS), fanout=fanout).collect()
    found = Counter(
        (r["doc_id"], r["leaf"], r["subroot"], r["root"], "".join(s["left"] + s["right"] for s in r["proof"])) for r in got
    )
    assert found == brute_manifest(rows, fanout)
    assert all(r["verified"] and r["folded_root"] == r["root"] for r in got)


def test_tampered_rows_do_not_verify(spark):
    df = spark.createDataFrame(manifest_rows(spark, 1, 50), DOCS)
    later = F.when(F.col("doc_id") % 5 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    got = merkle_manifest(df, found={"n_chars": later}).collect()
    assert all(r["verified"] == (r["doc_id"] is None or r["doc_id"] % 5 != 0) for r in got)
    assert merkle_manifest(df.limit(0)).count() == 0


# packing ------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def definition():
    public = pytest.importorskip("public_tokenizers")
    return Path(public.path(queries.WORD_TOKENIZER)).read_text(encoding="utf-8")


def brute_packing(counts, capacity):
    """Bins and what is left in them, one piece at a time."""
    rooms, bins = [], 0
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            at = bisect_left(rooms, length)
            room = rooms.pop(at) if at < len(rooms) else capacity
            bins += room == capacity
            insort(rooms, room - length)
    return bins, sorted(rooms)


def test_plan_is_that_of_single_pieces():
    rng = random.Random(5)
    for _ in range(200):
        capacity = rng.choice([1, 7, 20, 64])
        counts = {rng.randint(1, capacity): rng.randint(1, 60) for _ in range(rng.randint(0, 12))}
        plan, bins = best_fit_decreasing(counts, capacity), {}
        for i, (length, rank, first, per_bin, offset) in enumerate(plan):
            end = plan[i + 1][1] if i + 1 < len(plan) and plan[i + 1][0] == length else counts[length]
            for k in range(rank, end):
                bins.setdefault(first + (k - rank) // per_bin, []).append((offset + (k - rank) % per_bin * length, length))
        rooms = []
        for parts in bins.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            rooms.append(capacity - at)
        assert (len(bins), sorted(rooms)) == brute_packing(counts, capacity)


def test_words_are_encoded_as_whole_texts(definition):
    tokenizers = pytest.importorskip("tokenizers")
    whole, encoder, rng = tokenizers.Tokenizer.from_str(definition), WordEncoder(definition), random.Random(3)
    alphabet = "a|B|é|é|J̌|ǰ|́|1|२|'|'s|n't|<|!|-|\x0b|\x1c|\x85|\xa0| | |\t|\n|日本|İ|Σ|ß|ﬁ|\x00|​|'LL|K".split("|")
    alphabet += ["<|endoftext|>", "<|ENDOFTEXT|>", "|>"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(14))) for _ in range(5000)]
    texts.append("ab1,c'd" * 30_000)
    ids = encoder.encode([t.encode() for t in texts])
    for t, found in zip(texts, ids):
        assert found == b"".join(i.to_bytes(4, "little") for i in whole.encode(t, add_special_tokens=False).ids), t


def test_latin_words_need_merges_only(definition):
    tokenizers = pytest.importorskip("tokenizers")
    whole, encoder, rng = tokenizers.Tokenizer.from_str(definition), WordEncoder(definition), random.Random(5)
    latin = [chr(c) for c in [*range(0xC0, 0x100), *range(0x41, 0x5B), *range(0x61, 0x7B)] if c not in (0xD7, 0xF7)]
    words = ["".join(rng.choices(latin, k=rng.randrange(1, 9))) + rng.choice(("", "", ",", "!?", "7", "7é")) for _ in range(4000)]
    asked, encode_any = [], encoder._encode_any
    encoder._encode_any = lambda x: (asked.extend(x), encode_any(x))
    for word, found in zip(words, encoder.encode([w.encode() for w in words])):
        assert found == b"".join(i.to_bytes(4, "little") for i in whole.encode(word, add_special_tokens=False).ids), word
    assert all(len(w) < 3 and w.isascii() for w in asked)


def test_a_worker_keeps_its_encoder(definition):
    pytest.importorskip("tokenizers")
    assert packing._encoder(definition) is packing._encoder("".join(list(definition)))


def test_packing_of_a_table(spark, definition):
    tokenizers = pytest.importorskip("tokenizers")
    whole = tokenizers.Tokenizer.from_str(definition)
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    packed = pack_documents(documents, definition, 256, carry=["doc_id"], keep_ids=True).select("row.doc_id", "*").collect()
    by_doc, by_bin, counts = {}, {}, Counter()
    for r in packed:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_bin.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        counts[r["length"]] += 1
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    for r in documents.collect():
        ids = [*whole.encode(r["text"], add_special_tokens=False).ids, packing.END_ID]
        own = sorted(by_doc[r["doc_id"]], key=lambda x: x["piece"])
        assert b"".join(bytes(x["ids"]) for x in own) == b"".join(i.to_bytes(4, "little") for i in ids)
        assert [x["start"] for x in own] == list(range(0, len(ids), 256))
    for parts in by_bin.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert len(by_bin) == brute_packing(counts, 256)[0] and set(by_bin) == set(range(len(by_bin)))


def test_packing_awkward(spark, definition):
    packed = pack_documents(awkward(spark), definition, 64, keep_ids=True)
    rows = packed.collect()
    assert {r["row"]["doc_id"] for r in rows} == {1, 2, 3, 4, 5, 6, 7, None}
    assert all(sum(r["length"] for r in rows if r["row"]["doc_id"] == i) == 1 for i in (1, 2, 3))
    assert sum(r["row"]["doc_id"] == 5 for r in rows) == 2
    joined = sequences(packed).collect()
    assert sum(r["n_tokens"] for r in joined) == sum(r["length"] for r in rows)
    assert all(len(r["ids"]) == 4 * r["n_tokens"] <= 256 for r in joined)
    assert pack_documents(empty(spark), definition).count() == 0


# phrases ------------------------------------------------------------------------------------------------------


def brute_phrases(rows, least, top, longest=4):
    counts, sizes = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(w)
            for n in range(1, longest + 1):
                for i in range(len(w) - n + 1):
                    counts.setdefault(lang, Counter())[tuple(w[i : i + n])] += 1
    out = set()
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        best = []
        for p, a in candidates.items():
            if any(
                len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in candidates.items()
            ):
                continue
            s, _, left, right = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            best.append((-s, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(best)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -s))
    return out


def mined(df, **kw):
    names = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return {tuple(r[c] for c in names) for r in mine_collocations(df, **kw).collect()}


@pytest.mark.parametrize("held", [2_000_000, 50])
def test_phrases_equal_brute_force(spark, monkeypatch, held):
    """Also when tasks pass on what they hold all the time, and when every other prefix is hot."""
    monkeypatch.setattr(collocations, "HELD_ENTRIES", held)
    monkeypatch.setattr(collocations, "HELD_WORDS", held)
    monkeypatch.setattr(collocations, "HOT", 20 if held == 50 else 4096)
    rng = random.Random(9)
    words = ["the", "The", "of", "new", "york", "city", "aé", "x.y", "b", "c d"]
    text = lambda: "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", "\n"]) for _ in range(40))
    rows = [(i, text() + "new york city hall" * (i % 2), rng.choice(["en", "de", None, "und"]), None, None) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, rank string, n string").repartition(5)
    assert mined(df, least=6, top=25) == brute_phrases([(r[2], r[1]) for r in rows], 6, 25)


def test_phrases_awkward(spark):
    df = awkward(spark, [(9, "new york, new york new york", "en", "s", None)])
    pairs = brute_phrases([(r["lang"], r["text"]) for r in df.collect()], 2, 50)
    assert mined(df, least=2, top=50) == pairs and any(p[2] == "new york" for p in pairs)
    assert mined(empty(spark)) == set()


@pytest.mark.parametrize("name", ["op12_phrase_collocations", "op13_merkle_manifest"])
def test_new_queries_equal_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SF), SF, queries.ORACLE[name]) == []
