"""The training-data operators against plain versions, on sf0.001 and on odd rows."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from check_oracle import compare, connect
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from wiretide.llm import (
    cover_tree, interpolation, language_id, mixing, near_duplicates, packing, repetition, token_files, tokens, toxicity, url_filter,
)
from wiretide.llm import common
from wiretide.llm.common import fold, ship_package
from wiretide.llm.oracle import ORACLE_SQL
from wiretide.llm.queries import BYTE_TOKENIZER, QUERIES, WORD_TOKENIZER, tokenizer_path
from wiretide.sources.storage import work_folder

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 977} and{i % 7}" for i in range(12_000))
COPY = " ".join(f"copy{i}" for i in range(80))
ODD = [
    (1, None, "en", "a"), (2, "", "en", None), (3, " \n\t ", None, "b"), (4, "one", "de", "a"), (5, LONG, "en", "a"),
    (6, COPY, "en", "c"), (7, COPY, "fr", "c"), (7, COPY, "fr", "c"), (8, COPY + " x", "en", ""), (None, COPY, "en", "b"),
    (9, "the same line\n" * 40, "en", "b"), (10, "日本語 é \x1c ½ <|endoftext|> 'll", "ja", "d"), (11, "12345 ### 678", "en", "d"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows, with extra columns whose names the operators use themselves."""
    table = spark.createDataFrame(ODD, SCHEMA)
    for name in ("kept", "mix", "copy", "score", "component_id", "part", "train", "band", "dropped", "sequence_id", "file"):
        table = table.withColumn(name, F.lit("mine"))
    return table


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def documents():
    return pd.read_parquet(f"{SF}/documents.parquet").set_index("doc_id")


def words(text):
    return (text or "").encode().split()


def rows(df):
    return [r.asDict() for r in df.collect()]


# 1, 7: tokens, packing, files


@pytest.mark.parametrize("name, drops", [(WORD_TOKENIZER, True), (BYTE_TOKENIZER, False)])
def test_remembered_pieces_give_the_ids_of_the_whole_text(name, drops, documents):
    encoder = tokens.Encoder(tokenizer_path(name), drops)
    odd = ["a  b   c\n\n  d \n e\t\tf ", "don't 'S you're", "x\x1c y", "a\n b", "a \nb", " lead", "trail ", "a\r\nb", "e\u0301 \u0301x", "İΣς ẞ", "\u3000x\u3000 y", "a\n"]
    for text in [*odd, *documents.text[:60], *[r[1] for r in ODD if r[1]]]:
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), encoder.type).tolist() == want, repr(text[:80])


@pytest.mark.parametrize("name, drops", [(WORD_TOKENIZER, True), (BYTE_TOKENIZER, False)])
def test_added_tokens_in_texts_get_the_ids_of_the_library(name, drops, documents):
    fresh, encoder = Tokenizer.from_file(tokenizer_path(name)), tokens.Encoder(tokenizer_path(name), drops)
    marks = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext|", "<|endoftext|><|endoftext|>", "<|startoftext|>x<|endoftext|>"]
    around = ["{}", "a {} b", "a{}b", " {} ", "a  {}\n\n{} b", "\t{}\x1c", "é{} 日本{}", "don't {}'s", documents.text.iloc[0] + "{}" + documents.text.iloc[1]]
    for text in [a.replace("{}", m) for m in marks for a in around]:
        want = fresh.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), encoder.type).tolist() == want, repr(text[-80:])
    plain = [[320, 49407, 321], [64, 220, 50256, 275]][not drops]
    assert np.frombuffer(encoder.encode("a <|endoftext|> b"), encoder.type).tolist() == plain


def check_packing(table, result):
    """Every id in exactly one piece, sequences gapless; returns padding and ids."""
    encoder = tokens.encoder(tokenizer_path(WORD_TOKENIZER), True)
    want = Counter()
    for doc, text in table:
        ids = encoder.ids(text, 2).astype("<u4")
        want[(doc, len(ids), zlib.crc32(ids.tobytes()))] += 1
    documents = defaultdict(list)
    for r in result:
        documents[(r["doc_id"], r["doc_tokens"])].append(r)
    for (doc, n), pieces in documents.items():
        expected = [k for k in want.elements() if k[:2] == (doc, n)]
        ids = next(encoder.ids(t, 2).astype("<u4") for d, t in table if d == doc and len(encoder.ids(t, 2)) == n)
        covered = Counter()
        for p in pieces:
            assert p["ids_crc32"] == zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes())
            covered.update(range(p["start"], p["start"] + p["length"]))
        assert covered == Counter(dict.fromkeys(range(n), len(expected)))
    assert set(documents) == {k[:2] for k in want}
    sequences = defaultdict(list)
    for r in result:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    padding = total = 0
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 4096
        padding += 0 if end & (end - 1) == 0 else 4096 - end
        total += end
    return padding, total


def test_packing(spark, documents):
    result = rows(QUERIES["op1_packing"](spark, SF))
    padding, total = check_packing(list(documents.text.items()), result)
    assert padding < 4096 * 2 and total == sum({(r["doc_id"]): r["doc_tokens"] for r in result}.values())


def test_packing_of_odd_rows(odd, none):
    pack = lambda t: rows(packing.pack_documents(t, tokenizer_path(WORD_TOKENIZER)))
    check_packing([(d, t) for d, t, _, _ in ODD], pack(odd))
    assert pack(none) == []


def test_pack_fills_every_window_but_one():
    pieces = [packing.Piece(i, 0, np.arange(n), n) for i, n in enumerate([1, 5000, 700, 300, 2049, 512, 9000, 3, 4096])]
    windows, left = packing.pack(pieces)
    assert all(sum(map(len, w)) == tier for tier, w in windows)
    assert sum(sum(map(len, w)) for _, w in windows) + sum(map(len, left)) == sum(map(len, pieces))


def test_token_files(spark, documents):
    result = sorted(rows(QUERIES["op7_token_files"](spark, SF)), key=lambda r: r["doc_id"])
    encoder, start = tokens.encoder(tokenizer_path(BYTE_TOKENIZER), False), 0
    assert len(result) == len(documents)
    for r in result:
        ids = encoder.ids(documents.text[r["doc_id"]], 2).astype("<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_token_files_of_odd_rows(spark, odd, none):
    for table, n in ((odd, len(ODD)), (none, 0)):
        folder = work_folder(spark, "test-tokens")
        files = token_files.write_token_files(table, folder, tokenizer_path(BYTE_TOKENIZER))
        result = sorted(rows(token_files.read_token_files(spark, folder, files)), key=lambda r: r["start"])
        assert len(result) == n
        assert [r["start"] for r in result] == np.cumsum([0, *[r["n_tokens"] for r in result]])[:-1].tolist()
        assert [r["doc_id"] for r in result] == sorted((r["doc_id"] for r in result), key=lambda d: (d is not None, d))


def test_a_token_file_reads_single_documents_and_refuses_another_dictionary():
    arrays = [np.arange(n, dtype="<u2") for n in (0, 1, 500, 70)] * 40
    dictionary = token_files.train_dictionary([a.tobytes() for a in arrays], 2_000)
    writer = token_files.FileWriter(dictionary, 2)
    for i, a in enumerate(arrays):
        writer.add(i, a)
    reader = token_files.FileReader(writer.content(), dictionary)
    assert all((reader.ids(i) == a).all() for i, a in enumerate(arrays))
    with pytest.raises(ValueError, match="another dictionary"):
        token_files.FileReader(writer.content(), b"other")
    with pytest.raises(ValueError, match="cut"):
        token_files.FileReader(writer.content()[:-1], dictionary)


# 2, 3: what SQL expresses


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), connect(SF), ORACLE_SQL[name]) == ""


def test_targets_refill_until_none_is_above_its_cap(spark):
    sizes = {"a": 1, "b": 1000, "c": 10, "d": 0, None: 200}
    table = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(table).collect()}
    weight = dict(zip(["a", "b", "c", "d", None], [1, 2, 3, 1, 2]))
    target, left, free = dict.fromkeys(sizes, 0.0), float(sum(sizes.values())), set(sizes)
    while left > 1e-9:
        share = left / sum(weight[s] for s in free)
        left = 0.0
        for s in sorted(free, key=str):
            target[s] += share * weight[s]
            if target[s] >= 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
        free -= {s for s in free if target[s] >= 3 * sizes[s]}
    assert got == pytest.approx(target)


def test_mix_of_odd_rows(odd, none):
    mixed = rows(mixing.mix(odd))
    assert all(set(r) == set(odd.columns) for r in mixed)
    assert max(Counter((r["doc_id"], r["text"]) for r in mixed if r["doc_id"] != 7).values()) <= 3
    assert rows(mixing.mix(odd)) is not None and Counter(map(str, rows(mixing.mix(odd)))) == Counter(map(str, mixed))
    assert rows(mixing.mix(none)) == []


def test_urls(spark):
    urls = {
        None: ("", "", None, "allow"), "no scheme": ("", "", None, "allow"), "http://EXAMPLE.com/en/a?b": ("example.com", "/en/a", "example.com/en/", "block"),
        "http://x.www.example.com/en/#f": ("x.www.example.com", "/en/", "www.example.com/en/", "allow"), "x://a.net/fr/": ("a.net", "/fr/", "net/fr/", "block"),
        "http://casino-win.example.org/": ("casino-win.example.org", "/", None, "block"), "http://casinos.org/": ("casinos.org", "/", None, "allow"),
        "http://free.org/free?free": ("free.org", "/free", None, "allow"), "http://free.org/win": ("free.org", "/win", None, "block"), "http://com": ("com", "", None, "allow"),
        "": ("", "", None, "allow"),
    }
    table = spark.createDataFrame([(i, u, "mine", "mine") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(table).collect()}
    assert [got[i] for i in range(len(urls))] == list(urls.values())
    assert rows(url_filter.judge(table.limit(0))) == []


def test_a_vocabulary_from_a_table_decides(spark):
    weights = [("Casino", 1.0), ("casino", 0.2), ("Bet", 0.5), ("365", 0.5), ("x-ray", 0.5), ("жар", 2.0), ("", 3.0), (None, 1.0), ("idle", 0.0), ("none", None), ("nan", math.nan)]
    strict, soft = url_filter.vocabulary(spark.createDataFrame(weights, "term string, weight double"))
    assert (strict, soft) == (("casino", "жар"), ("365", "bet", "x-ray"))
    rng, parts = random.Random(5), ["casino", "Casinos", "bet", "365", "1365", "x-ray", "x", "ray", "жар", "nan", "best", "7", "é"]
    urls = [f"http://{''.join(rng.choice(parts) + rng.choice(['', '', '-', '.', '/']) for _ in range(rng.randrange(1, 6)))}" for _ in range(400)]

    def plain(url):
        text = url.translate(url_filter._LOWER)
        edge = {True: "[a-z]", False: "[0-9]"}
        hit = lambda t: re.findall(
            "(?=" + ("(?<!%s)" % edge[t[0].isalpha()] if t[0].isascii() else "") + re.escape(t) + ("(?!%s)" % edge[t[-1].isalpha()] if t[-1].isascii() else "") + ")", text
        )
        return sum(len(hit(t)) for t in strict), sum(bool(hit(t)) for t in soft)

    table = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: r for r in url_filter.judge(table, rules=(), strict=strict, soft=soft).collect()}
    for i, url in enumerate(urls):
        hits = plain(url)
        assert (got[i]["strict_hits"], got[i]["soft_terms"]) == hits, url
        assert got[i]["verdict"] == ("block" if hits[0] or hits[1] >= 2 else "allow")
    assert 100 < sum(r["verdict"] == "block" for r in got.values()) < 350
    assert {r["verdict"] for r in url_filter.judge(table, rules=(), strict=(), soft=()).collect()} == {"allow"}


# 4, 8: learned models


def test_languages(spark, odd, none, documents):
    result = pd.DataFrame(rows(QUERIES["op4_language_id"](spark, SF))).set_index("doc_id")
    held = result[result.held_out]
    assert (held.lang_pred == documents.lang[held.index]).mean() > 0.9
    assert {i for i in result.index if zlib.crc32(str(i).encode()) % 5 == 0} == set(held.index)
    model = language_id.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    got = {r["doc_id"]: r for r in language_id.identify(odd, model).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 and got[i]["rejected"] for i in (1, 2, 3, 11))
    assert language_id.keep_known(odd, model).columns == odd.columns
    nothing = language_id.fit(none)
    assert {r["lang_pred"] for r in language_id.identify(odd, nothing).collect()} == {"und"}
    assert rows(language_id.identify(none, nothing)) == []


def test_texts_of_no_learned_language_are_rejected(spark):
    documents, rng = pd.read_parquet("/root/testdata/sf0.01/documents.parquet").set_index("doc_id"), np.random.default_rng(11)
    run = lambda a, b, n: "".join(map(chr, rng.integers(a, b, n)))
    spaced = lambda a, b, n: " ".join(run(a, b, k) for k in rng.integers(2, 9, n))[:n]
    learned = documents.iloc[: len(documents) * 4 // 5]
    # One mislabelled long text of another script and one of random letters are in what is learned from.
    noise = [(10**6, spaced(0x430, 0x450, 200_000), "en"), (10**6 + 1, spaced(97, 123, 50_000), "de")]
    table = [*zip(map(int, learned.index), learned.text, learned.lang), *noise]
    model = language_id.fit(spark.createDataFrame(table, "doc_id long, text string, lang string"))
    for n in (8, 20, 60, 200, 2_000, 40_000, 300_000):
        for first, last in ((0x4E00, 0x9000), (0x621, 0x64A), (0x5D0, 0x5EA)):
            assert model.predict(spaced(first, last, n))[2] and model.predict(run(first, last, n))[2], (n, hex(first))
        if n >= 60:
            assert model.predict(spaced(97, 123, n))[2], n
    held = documents.iloc[len(learned) :]
    for n in (20, 60, 200, 2_000, 10**9):
        assert np.mean([model.predict(t[:n])[2] for t in held.text if language_id.has_letter(t[:n])]) < 0.03, n
    for lang, own in documents.groupby("lang"):
        for n in (40_000, 2_000_000):
            text = " ".join(own.text)
            text = (text * (n // len(text) + 1))[:n]
            assert model.predict(text)[::2] == (lang, False), (lang, n)


def test_toxicity(spark, odd, none):
    sf = "/root/testdata/sf0.1"  # the smaller ones hold out a handful of toxic texts
    result = pd.DataFrame(rows(QUERIES["op8_toxicity"](spark, sf))).merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    held = result[result.held_out]
    good, bad = held[held.toxic == 1].score.to_numpy(), held[held.toxic == 0].score.to_numpy()
    assert (good[:, None] > bad).mean() > 0.9 and (good >= 0.5).mean() > 0.9 and (bad >= 0.5).mean() < 0.01
    labels = spark.createDataFrame([(6, 1), (4, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.fit(odd, labels)
    got = rows(toxicity.score(odd, model))
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert rows(toxicity.score(none, toxicity.fit(none, labels))) == []
    assert toxicity.fit(odd, labels.limit(0)).scores([None, "x"]).max() < 1e-9


def test_a_few_positives_are_enough_to_learn_from(spark):
    rng, common = np.random.default_rng(3), [f"w{i}" for i in range(400)]
    text = lambda *more: " ".join([*rng.choice(common, 60), *more])
    for positives in (1, 3, 12):
        table = [(i, text(*["vilesnarl", "gutterfoul"][: 1 + i % 2] * 3) if i < positives else text()) for i in range(400)]
        docs = spark.createDataFrame(table, "doc_id long, text string")
        labels = spark.createDataFrame([(i, int(i < positives)) for i in range(100)], "doc_id long, toxic int")
        model = toxicity.fit(docs, labels)
        new = model.scores([text("vilesnarl", "vilesnarl", "vilesnarl"), *(text() for _ in range(50)), "", None])
        assert new[0] > 3 * new[1:].max() and new[0] > 0.01, positives


def test_the_risk_estimator_separates_what_is_separable():
    rng = np.random.default_rng(1)
    positive, unlabelled = rng.random((200, 4)) + [1, 0, 0, 0], rng.random((800, 4))
    unlabelled[:80, 0] += 1
    weights, bias = toxicity.fit_risk(positive, unlabelled, 0.1)
    p = lambda x: 1 / (1 + np.exp(-(x @ weights + bias)))
    assert p(positive).mean() > 0.7 and p(unlabelled[80:]).mean() < 0.2


# 6: repetition


def plain_repetition(text, window=3, least=8):
    w = words(text)
    seen = Counter(tuple(w[i : i + window]) for i in range(len(w) - window + 1))
    windows = {j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
    at = defaultdict(list)
    for i in range(len(w) - least + 1):
        at[tuple(w[i : i + least])].append(i)
    covered, longest = set(), 0
    for places in at.values():
        for i in places if len(places) > 1 else ():
            n = max(next((k for k in range(len(w)) if max(i, j) + k >= len(w) or w[i + k] != w[j + k]), 0) for j in places if j != i)
            covered |= set(range(i, i + n))
            longest = max(longest, n)
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(len(x.decode()) for x in w), sum(map((text or "").count, "#*$%&|<>")), len(lines) - len(set(lines)), len(windows), len(covered), longest)


def test_intervals_of_common_prefixes():
    rng = np.random.default_rng(12)
    for n, k in ((1, 1), (12, 1), (60, 2), (200, 3), (300, 20)):
        ids = np.append(rng.integers(0, k, n), k)
        order, _ = repetition.suffix_array(ids)
        lcp = repetition.common_prefixes(ids, order)
        found = repetition.lcp_intervals(lcp, 2)
        want = set()
        for i in range(len(lcp)):
            for j in range(i, len(lcp)):
                h = lcp[i + 1 : j + 1].min() if j > i else 0
                if h >= 2 and (i == 0 or lcp[i] < h) and (j + 1 == len(lcp) or lcp[j + 1] < h):
                    want.add((int(h), i, j))
        intervals = list(zip(found.height.tolist(), found.first.tolist(), found.last.tolist()))
        assert set(intervals) == want and len(intervals) == len(want)
        for t, (h, a, b) in enumerate(intervals):
            around = [x for x in intervals if x[0] < h and x[1] <= a and b <= x[2]]
            assert (intervals[found.outer[t]] if found.outer[t] >= 0 else None) == max(around, default=None)
        for i in range(len(lcp)):
            inner = [x for x in intervals if x[1] <= i <= x[2]]
            assert (intervals[found.inner_of[i]] if found.inner_of[i] >= 0 else None) == max(inner, default=None)
        # Maximal repeats: no word more on either side.
        w, starts = ids[:-1].tolist(), repetition.maximal_repeats(ids, order, lcp, 2)
        for i in range(n):
            lengths = [m for m in range(2, n - i + 1) for same in [[j for j in range(n - m + 1) if w[j : j + m] == w[i : i + m]]]
                       if len(same) > 1 and len({w[j - 1] if j else -1 for j in same}) > 1 and len({w[j + m] if j + m < n else -1 for j in same}) > 1]
            assert starts[i] == max(lengths, default=0)
            if n > 60:
                break


def test_repetition(documents, odd, none):
    rng = np.random.default_rng(3)
    texts = [t for _, t, _, _ in ODD if t != LONG] + documents.text[:80].tolist()
    texts += [" ".join(rng.choice(list("abc"), n)) for n in range(60)]
    found = repetition.measure(texts)
    names = [*repetition.COLUMNS, "covered_words", "longest_repeat"]
    for i, text in enumerate(texts):
        assert tuple(int(found[c][i]) for c in names) == plain_repetition(text), repr(text)
    judged = {r["doc_id"]: r for r in rows(repetition.judge(odd))}
    assert judged[1]["base_failed"] and judged[9]["base_failed"] and judged[6]["kept"]
    assert repetition.keep_good(odd).columns == odd.columns and rows(repetition.judge(none)) == []


# 5, 9: near duplicates


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def plain_near(table, n=2):
    sets = {}
    for doc, text in table:
        w = (text or "").encode().lower().split()
        sets[doc] = {tuple(w[i : i + n]) for i in range(max(len(w) - n, 0) + 1)} if w else set()
    ids = [d for d in sets if sets[d]]
    return sets, components(sets, [(a, b) for a in ids for b in ids if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])])


def test_near_duplicates(spark, documents):
    sets, want = plain_near(documents.text.items())
    for r in rows(QUERIES["op9_near_duplicates"](spark, SF)):
        i = r["doc_id"]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[i]), want[i], want[i] == i)


def test_near_copies_that_meet_only_through_their_original(spark):
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(120)]
    table = [(0, " ".join(base))]
    for i in range(1, 60):
        w = list(base)
        for j in rng.choice(120, 6 + i % 9, replace=False):
            w[j] = f"x{i}_{j}"
        table.append((i, " ".join(w)))
    _, want = plain_near(table)
    df = spark.createDataFrame(table, "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in rows(near_duplicates.near_duplicates(df, 2))} == want


def test_near_duplicates_of_odd_rows(odd, none):
    got = [(r["doc_id"], r["component_id"], r["kept"]) for r in rows(near_duplicates.near_duplicates(odd))]
    assert len(got) == len(ODD)
    assert {g for g in got if g[0] in (6, 7, 8, None)} == {(6, 6, True), (7, 6, False), (8, 6, False), (None, None, True)}
    assert all(c == i and k for i, c, k in got if i in (1, 2, 3, 4, 5))
    # Every row is a document there, so the one without an id goes too.
    assert sorted(r["doc_id"] or 0 for r in rows(near_duplicates.keep_one(odd))) == [1, 2, 3, 4, 5, 6, 9, 10, 11]
    assert rows(near_duplicates.near_duplicates(none)) == []


def test_near_vectors(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(6, 16))
    data = []
    for i in range(300):
        v = base[i % 6] + rng.normal(size=16) * rng.choice([0.0, 0.05, 0.2, 0.3, 3.0])
        data.append((i, v.tolist(), int(i % 3 == 0)))
    data += [(300, None, 1), (301, [0.0] * 16, 1), (302, [1.0, None] * 8, 1), (303, [float("nan")] * 16, 1), (304, [float("inf")] + [0.0] * 15, 1)]
    data += [(305, data[0][1], None), (306, [], 1), (307, data[0][1], data[0][2]), (308, [x * 1e200 for x in data[0][1]], data[0][2])]
    table = spark.createDataFrame([(*r, "mine") for r in data], "vec_id long, embedding array<double>, label int, kept string")
    unit = {i: np.array(v) / np.linalg.norm(np.array(v) / max(map(abs, v))) / max(map(abs, v)) for i, v, y in data if (i < 300 or i > 306) and y is not None}
    label = {i: y for i, _, y in data}
    links = [(a, b) for a in unit for b in unit if a < b and label[a] == label[b] and unit[a] @ unit[b] >= 0.93]
    counts, want = Counter(x for pair in links for x in pair), components([r[0] for r in data], links)
    got = rows(cover_tree.near_vectors(table))
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == {i: (counts[i], want[i], want[i] == i) for i in want}
    assert len(links) > 100 and rows(cover_tree.near_vectors(table.limit(0))) == []


def test_blocks_and_trees_agree_with_all_pairs():
    rng = np.random.default_rng(9)
    v = np.repeat(rng.normal(size=(20, 8)), 15, axis=0) + rng.normal(size=(300, 8)) * np.repeat(rng.choice([0.01, 0.1, 0.4], 20), 15)[:, None]
    v /= np.linalg.norm(v, axis=1)[:, None]
    a, b, weights = v[:200], v[200:], np.arange(1.0, 301)
    left, right, _ = cover_tree.dual_traversal(cover_tree.build(a, weights[:200]), cover_tree.build(b, weights[200:]), a, b, False, 0.93)
    linked = a @ b.T >= 0.93
    assert (left == linked @ weights[200:]).all() and (right == weights[:200] @ linked).all() and linked.any()


# 10: language model


def test_interpolation(spark, documents):
    texts = {i: [*(t or "").encode().lower().split(), None] for i, t in documents.text.items()}
    train = {i for i in texts if zlib.crc32(str(i).encode()) % 7 != 2}
    count = Counter(w for i in train for w in texts[i])
    n, v = sum(count.values()), len(count)
    got = rows(QUERIES["op10_interpolation"](spark, SF))
    assert len(got) == len(texts)
    for r in got:
        own = texts[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (r["doc_id"] not in train, len(own), sum(count[w] > 0 for w in own), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own))
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def plain_interpolation(texts, train):
    """log10 probability per document: exact counts, weights by expectation-maximisation on deleted counts."""
    word, pair = Counter(), Counter()
    sequences = {i: [*(t or "").encode().lower().split(), None] for i, t in texts.items()}
    for i in train:
        word.update(sequences[i])
        pair.update(zip(["begin", *sequences[i]], sequences[i]))
    context = word + Counter({"begin": len(train)})
    n, v = sum(word.values()), len(word)
    ratio = lambda a, b: a / b if b > 0 else 0.0
    level = lambda seen: min(1 + int(math.log2(seen)), interpolation.CLASSES - 1) if seen > 0 else 0
    held = defaultdict(Counter)
    for i in train:
        for a, b in zip(["begin", *sequences[i]], sequences[i]):
            held[level(context[a] - 1)][ratio(pair[a, b] - 1, context[a] - 1), ratio(word[b] - 1, n - 1)] += 1
    weights, last = {}, np.array([0.0, 0.5, 0.5])
    for c in range(interpolation.CLASSES):
        if held[c]:
            ml = np.array([[x, y, 1 / (v + 1)] for x, y in held[c]])
            times = np.array(list(held[c].values()), dtype=float)
            last = np.full(3, 1 / 3)
            for _ in range(interpolation.ROUNDS):
                share = ml * last
                last = np.maximum((times[:, None] * share / share.sum(axis=1, keepdims=True)).sum(axis=0) / times.sum(), [0, 0, 1e-6])
                last = last / last.sum()
        weights[c] = last
    out = {}
    for i, sequence in sequences.items():
        out[i] = 0.0
        for a, b in zip(["begin", *sequence], sequence):
            w = weights[level(context[a])]
            out[i] += math.log10(w[0] * ratio(pair[a, b], context[a]) + w[1] * ratio(word[b], n) + w[2] / (v + 1))
    return out


@pytest.mark.parametrize("partitions", [1, 7])
def test_scores_equal_a_plain_model(spark, documents, partitions):
    texts = documents.text.to_dict() | {10**6: None, 10**6 + 1: "never seen words", 10**6 + 2: "the the THE"}
    train = [i for i in texts if zlib.crc32(str(i).encode()) % 7 != 2]
    want = plain_interpolation(texts, train)
    table = spark.createDataFrame([*texts.items()], "doc_id long, text string").repartition(partitions)
    got = {r["doc_id"]: r["score"] for r in rows(interpolation.score_documents(table, fold(F.col("doc_id"), 7) != 2))}
    # Held-out probabilities are counted to a quarter of a power of two, which moves the weights a little.
    assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i], rel=2e-3) for i in want)


def test_interpolated_probabilities_are_never_zero(spark):
    table = spark.createDataFrame([(0, "a b a b a c"), (1, "a b"), (2, "b z"), (3, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in rows(interpolation.score_documents(table, F.col("doc_id") < 2))}
    # Unseen after "b", and not at all: only the uniform part is left, which never is 0.
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got.values())
    assert got[3]["n_tokens"] == 1 and got[2]["n_known"] == 2


@pytest.mark.parametrize("vocabulary, partitions", [(["a"], 1), (["b"], 1), (["c"], 1), (["a", "b", "c"], 24)])
def test_few_words_over_many_slices_count_as_types_once(spark, vocabulary, partitions):
    texts = {i: [*(vocabulary[(i + j) % len(vocabulary)] for j in range(i % 5)), "new"][: i % 5 + (i % 7 == 2)] for i in range(96)}
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string").repartition(partitions)
    train = {i for i in texts if i % 7 != 2}
    count = Counter(w for i in train for w in [*texts[i], None])
    n, v = sum(count.values()), len(count)
    got = rows(interpolation.score_documents(table, F.col("doc_id") % 7 != 2))
    assert len(got) == len(texts) and v == len(vocabulary) + 1
    for r in got:
        own = [*texts[r["doc_id"]], None]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(count[w] > 0 for w in own), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own))


def test_counts_asked_by_groups_of_chunks_are_the_same(spark):
    # 19 chunks: 32 slices, or 8 of each of 4 groups of chunks.
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").repartition(19)
    train = fold(F.col("doc_id"), 7) != 2
    whole, grouped = (rows(interpolation.score_documents(table, train, most=most)) for most in (interpolation.MOST_SLICES, 4))
    assert len(whole) > 0 and sorted(map(str, whole)) == sorted(map(str, grouped))


def test_interpolation_of_odd_rows(odd, none):
    got = rows(interpolation.score_documents(odd, fold(F.col("doc_id"), 7) != 2))
    assert len(got) == len(ODD) and all(math.isfinite(r["score"]) for r in got)
    assert rows(interpolation.score_documents(none, F.lit(True))) == []
    untrained = rows(interpolation.score_documents(odd, F.lit(False)))
    assert {r["train_tokens"] for r in untrained} == {0} and {r["n_known"] for r in untrained} == {0}


# pipeline


def test_pipeline(spark, documents):
    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), f"test-{name}")
        seen.append((name, docs))
    assert all(d.columns == columns for _, d in seen[:-1])
    ids = [{r["doc_id"] for r in d.select("doc_id").collect()} for _, d in seen]
    bad = {i for i, t in documents.text.items() if len(words(t)) < 50}
    assert not ids[1] & bad and ids[3] <= ids[2] <= ids[1] <= ids[0] and len(ids[1]) > 100
    _, want = plain_near([(i, documents.text[i]) for i in ids[1]], 5)
    assert ids[2] == {i for i in ids[1] if want[i] == i}
    mixed = [(r["doc_id"], r["text"]) for r in seen[3][1].collect()]
    check_packing(mixed, rows(seen[4][1]))
    assert spark.createDataFrame([], seen[0][1].schema).columns == columns


def test_the_pipeline_hands_texts_to_python_by_bytes(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    sizes = lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"]) for b in batches)
    texts = spark.range(0, 6_000, 1, 1).select("id", F.repeat(F.lit("word "), 1_000).alias("text"))
    before = spark.conf.get(name, None)
    try:
        for _, stage in corpus_pipeline.STAGES:
            if stage is not corpus_pipeline.mix_sources:
                assert stage.__wrapped__
        common.in_small_batches(lambda session: None)(spark)
        assert max(r.n for r in texts.mapInArrow(sizes, "n long").collect()) < 2 * common.BATCH_BYTES
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
