"""License scan, conversation trie and periodic runs against plain versions, on sf0.001 and on odd rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wiretide.llm import conversation_trie, license_scan, periodic_runs
from wiretide.llm.common import ship_package
from wiretide.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
CLASHING = ("words", "n", "score", "labels", "start", "position", "conv", "depth", "p1", "slice", "place", "base", "turns", "kept", "list_of_words")


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="module")
def documents():
    return pd.read_parquet(f"{SF}/documents.parquet").set_index("doc_id")


def rows(df):
    return [r.asDict() for r in df.collect()]


def with_clashes(table):
    for name in CLASHING:
        table = table.withColumn(name, F.lit("mine"))
    return table


# 11: license notices

NOTICE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def notice_words(text):
    return NOTICE_WORD.findall((text or "").translate(LOWER))


def plain_base(text):
    w = notice_words(text)
    places = [(i, label) for label, phrase in license_scan.PHRASES for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in places]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def plain_closest(text, pattern):
    """The fewest edits that make the pattern of some whole consecutive words."""
    w, n, least = notice_words(text), len(pattern.split()), len(pattern)
    for i in range(len(w)):
        for j in range(i + 1, min(i + n + 6, len(w)) + 1):
            part = " ".join(w[i:j])
            if abs(len(part) - len(pattern)) < least:
                least = min(least, edit_distance(part, pattern))
    return least


def damaged(rng, pattern, edits):
    out = list(pattern)
    for _ in range(edits):
        at, kind = int(rng.integers(1, len(out) - 1)), rng.integers(3)
        if kind == 0:
            out[at] = "q"
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, "z")
    return "".join(out)


def test_base_phrases(spark, documents):
    got = {r["doc_id"]: r for r in rows(QUERIES["op11_license_scan"](spark, SF))}
    assert len(got) == len(documents)
    for i, text in documents.text.items():
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == plain_base(text)
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert sum(r["n_base"] for r in got.values()) > 0


def test_base_phrases_overlap_and_end_at_word_ends():
    texts = ["MIT License", "mit license mit license", "xmit license", "mit licenses", "mit\n# license!", "général public license", "the General  Public-License", "mit_license", "é mit license日", "mit license 日 Apache license"]
    tool = license_scan.Scanner()
    for text in texts:
        n, found = tool.scan(text)
        base = [m for m in found if m.base]
        starts = [m.first for m in base]
        assert (n, len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({m.label for m in base}))) == plain_base(text), text


def test_notices_are_found_up_to_their_edits_and_not_beyond():
    rng, tool = np.random.default_rng(4), license_scan.Scanner()
    for i, (label, pattern) in enumerate(license_scan.NOTICES):
        k = license_scan.edits_allowed(pattern)
        for edits in range(k + 3):
            text = f"Some words, before it; {damaged(rng, pattern, edits).replace(' ', chr(10) + ' * ', 2)}. And more after."
            least = plain_closest(text, pattern)
            found = [m for m in tool.scan(text)[1] if not m.base and m.pattern == pattern]
            assert bool(found) == (least <= k), (label, edits, least)
            assert not found or found[0].errors == least


def test_spans_are_those_of_the_text_and_long_texts_are_read_to_their_end(spark):
    notice = "Licensed under the Apache Licence, version 2.0"
    text = "word " * 50_000 + "\n// " + notice.replace("the", "the\n//") + "\n" + "mit license " * 3_000 + notice
    table = with_clashes(spark.createDataFrame([(1, text), (2, None), (3, ""), (3, ""), (None, "MIT license"), (4, " \n ,;")], "doc_id long, text string"))
    got = rows(license_scan.find_notices(table))
    fuzzy = [r for r in got if not r["base"] and r["doc_id"] == 1]
    assert [r["label"] for r in fuzzy] == ["apache", "apache"] and all(r["errors"] == 1 for r in fuzzy)
    assert all(text[r["start"] : r["end"]] == r["found"] for r in got if r["doc_id"] == 1) and fuzzy[1]["found"] == notice
    assert fuzzy[0]["first_word"] == 50_000
    told = rows(license_scan.scan_documents(table))
    assert sorted((r["doc_id"] or 0, r["n_base"], r["labels"], r["score"]) for r in told) == [
        (0, 1, "mit", 1.0), (1, 3_000, "apache,mit", 1.0), (2, 0, "", 0.0), (3, 0, "", 0.0), (3, 0, "", 0.0), (4, 0, "", 0.0),
    ]
    assert rows(license_scan.scan_documents(table.limit(0))) == [] and rows(license_scan.find_notices(table.limit(0))) == []


def test_lists_of_ones_own():
    tool = license_scan.Scanner((("x", "x y"),), (("house", "for internal use within the house only"),))
    assert [(m.label, m.errors) for m in tool.scan("x Y x y. For internal use wihin the house only")[1]] == [("x", 0), ("x", 0), ("house", 1)]


# 12: conversation trie


def plain_trie(turns, base=lambda c: c - int(np.fmod(c, 100)), head=lambda c: zlib.crc32(str(c).encode()) % 6):
    """turns: (conv, turn, role, text) in the order of equal turn numbers."""
    stored = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            stored[conv].append(((turn is not None, turn or 0), (role or "", text or "")))
    for conv in stored:
        stored[conv] = [t for _, t in sorted(stored[conv], key=lambda x: x[0])]
    rebuilt = {c: tuple(stored.get(base(c), [])[: head(c)] + own[head(c) :]) for c, own in stored.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, seq in sorted(rebuilt.items()):
        ends[seq].append(c)
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    kids, leaves, saved = Counter(), Counter(), Counter()
    for node, of in members.items():
        if node:
            kids[node[:-1]] += 1
    for node, of in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += kids[node] == 0
            saved[node[:d]] += (len(of) - 1) * len(node[-1][1]) if node else 0
    return sorted(
        (of[0], len(node), members[node[:-1]][0] if node else -1, len(of), kids[node], leaves[node], saved[node], hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest())
        for node, of in members.items()
    )


TRIE = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
TURNS = "conv_id long, turn long, role string, text string"


def trie(table, **more):
    from wiretide.llm.common import id_crc32

    made = conversation_trie.prefix_trie(table, **{"base": lambda c: c - c % 100, "head": lambda c: id_crc32(c) % 6, "most_head": 5, **more})
    assert made.columns == TRIE
    return sorted(tuple(-1 if r[c] is None else r[c] for c in TRIE) for r in made.collect())


def test_trie_of_the_table(spark):
    table = pd.read_parquet(f"{SF}/conversations.parquet")
    want = plain_trie([tuple(r) for r in table[["conv_id", "turn", "role", "text"]].itertuples(index=False)])
    assert sorted(tuple(-1 if r[c] is None else r[c] for c in TRIE) for r in rows(QUERIES["op12_conversation_trie"](spark, SF))) == want


def odd_turns():
    rng, out = np.random.default_rng(8), []
    for c in [*range(-3, 30), 100, 101, 205, 250, 300, 350, 10**12 + 7]:
        # Few texts, so that prefixes meet; some conversations are copies, some one turn, one is hot.
        n = 400 if c == 7 else int(rng.integers(1, 9))
        texts = rng.integers(0, 2, n) if c % 3 else np.zeros(n, dtype=int)
        out += [(c, None if i == 0 and c % 2 else i, [None, "user"][int(texts[i])], ["", "日本 a", None][int(texts[i]) + (i == 3)]) for i in range(n)]
    return [*out, *[r for r in out if r[0] in (5, 7)][:250], (None, 1, "user", "nobody's")]


def test_trie_of_odd_rows(spark, monkeypatch):
    turns = odd_turns()
    # Equal numbers: repeated rows only, whose order does not matter.
    table = with_clashes(spark.createDataFrame(turns, TURNS)).repartition(5)
    want = plain_trie(turns)
    assert trie(table) == want and any(r[0] == 7 and r[1] > 300 for r in want)
    monkeypatch.setattr(conversation_trie, "BLOCK_TURNS", 16)
    monkeypatch.setattr(conversation_trie, "PIECE_IDS", 3)
    assert trie(table) == want
    assert trie(table.limit(0)) == []


def test_trie_with_heads_of_ones_own(spark):
    turns = odd_turns()
    plain = plain_trie(turns, base=lambda c: 5, head=lambda c: 2)
    table = spark.createDataFrame(turns, TURNS)
    assert trie(table, base=lambda c: F.lit(5).cast("long"), head=lambda c: F.lit(2), most_head=2) == plain
    assert trie(table, base=lambda c: c, head=lambda c: F.lit(0), most_head=0) == plain_trie(turns, head=lambda c: 0)


def test_a_wrong_hash_is_noticed(spark, monkeypatch):
    table = spark.createDataFrame([(1, 0, "user", "a"), (2, 0, "user", "b")], TURNS)
    monkeypatch.setattr(conversation_trie.F, "xxhash64", lambda *c: F.lit(1).cast("long"))
    with pytest.raises(ValueError, match="one hash"):
        trie(table)


def test_powers_have_inverses():
    n = np.array([0, 1, 2, 63, 64, 1000, 10**12, -1, -77])
    for lane, base in enumerate(conversation_trie.BASES):
        assert conversation_trie.powers(lane, n).tolist() == [pow(base, int(e), 1 << 64) for e in n]


# 13: runs


def plain_runs(w, least=6, periods=4):
    out, n = set(), len(w)
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            if length >= max(least, periods * q) and not any(all(w[x] == w[x + p] for x in range(i, i + length - p)) for p in range(1, q)):
                out.add((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_summary(w):
    runs = plain_runs(w)
    gone = {x for s, n, q in runs for x in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    text = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    digest = lambda t: hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest()
    kept = [x for i, x in enumerate(w) if i not in gone]
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None, digest(text), digest(" ".join(kept)), len(kept))


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def planted(doc, w):
    h, n = zlib.crc32(str(doc).encode()), len(w)
    if h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


SUMMARY = "n_runs start length period exponent_milli runs_sha256 collapsed_sha256 n_words_kept".split()


def test_runs_of_the_table(spark, documents):
    got = {r["doc_id"]: tuple(r[c] for c in SUMMARY) for r in rows(QUERIES["op13_periodic_runs"](spark, SF))}
    short = [i for i, t in documents.text.items() if len(split(t)) < 1_500]
    assert len(got) == len(documents) and len(short) > 100
    for i in short:
        assert got[i] == plain_summary(planted(i, split(documents.text[i]))), i
    assert sum(r[0] > 0 for r in got.values()) > 5


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab", max_size=60).map(list), max_size=4), st.integers(3, 5), st.integers(1, 8))
def test_runs_of_short_alphabets(texts, periods, least):
    starts = np.cumsum([0, *map(len, texts)])
    words = np.array([ord(c) for t in texts for c in t], dtype=np.int64)
    got = list(zip(*(x.tolist() for x in periodic_runs.find_runs(words, starts, least, periods))))
    assert got == [(i, *r) for i, t in enumerate(texts) for r in plain_runs(t, least, periods)]


def test_runs_of_many_periods():
    rng = np.random.default_rng(2)
    texts = []
    for q in [1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31, 33, 64, 65]:
        unit = [f"u{x}" for x in rng.integers(0, max(q // 2, 2), q)]
        for n in (4 * q - 1, 4 * q, 4 * q + 1, 6 * q + q // 2):
            texts.append(["x", *(unit * 8)[:n], "y", *(unit * 8)[1 : n + 1]])
    found = [list(zip(*(x.tolist() for x in r))) for _, *r in periodic_runs.runs_of([" ".join(t) for t in texts])]
    assert found == [plain_runs(t) for t in texts]


def test_runs_of_odd_rows(spark):
    long = "a b " * 40_000 + "c"
    table = [(1, None), (2, ""), (3, " \n"), (4, "x " * 5), (5, "x " * 6), (6, long), (6, long), (None, "é 日 " * 9), (7, "one two")]
    got = sorted(rows(periodic_runs.summarize(with_clashes(spark.createDataFrame(table, "doc_id long, text string")))), key=lambda r: (r["doc_id"] or 0, r["n_runs"]))
    want = {d: plain_summary(split(t)) for d, t in table if d != 6}
    want[6] = (1, 0, 80_000, 2, 40_000_000, hashlib.sha256(b"0,80000,2\n").hexdigest(), hashlib.sha256(b"a b c").hexdigest(), 3)
    assert len(got) == len(table) and all(tuple(r[c] for c in SUMMARY) == want[r["doc_id"]] for r in got)
    clashing = with_clashes(spark.createDataFrame(table, "doc_id long, text string"))
    collapsed = rows(periodic_runs.collapse(clashing))
    assert {(r["doc_id"], r["text"]) for r in collapsed} == {(1, None), (2, ""), (3, " \n"), (4, "x " * 5), (5, "x"), (6, "a b c"), (None, "é 日"), (7, "one two")}
    assert all(set(r) == {"doc_id", "text", *CLASHING} for r in collapsed)
    each = rows(periodic_runs.run_table(clashing))
    assert sorted((r["doc_id"] or 0, r["start"], r["length"], r["period"], r["unit"]) for r in each) == [(0, 0, 18, 2, "é 日"), (5, 0, 6, 1, "x"), *[(6, 0, 80_000, 2, "a b")] * 2]
    nothing = clashing.limit(0)
    assert rows(periodic_runs.summarize(nothing)) == [] and rows(periodic_runs.run_table(nothing)) == [] and rows(periodic_runs.collapse(nothing)) == []


def test_planted_periods_of_odd_rows(spark):
    table = [(i, t) for i in range(40) for t in (None, "", "a", "a b c", " ".join(f"w{j}" for j in range(50)))] + [(None, "a b c d e f")]
    docs = with_clashes(spark.createDataFrame(table, T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])))
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)
    made = periodic_runs.with_period(docs, h % 10 == 0, lambda n: g % n, lambda n, a: 1 + F.floor((n - a) / (3 + g % 8)))
    assert made.columns == docs.columns
    got = Counter((r["doc_id"], r["text"]) for r in made.collect())
    name = lambda d: "" if d is None else d
    want = Counter((d, " ".join(planted(name(d), split(t))) if split(t) and zlib.crc32(str(name(d)).encode()) % 10 == 0 else t) for d, t in table)
    assert got == want
