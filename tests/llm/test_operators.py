"""Each operator against a brute-force version or the public library, with odd rows among ordinary ones."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from compare import differences
from conftest import SF_DIR
from pyspark.sql import functions as F

from deliverylens.llm import byte_bpe, common, lm_contrast, near_dedup, pfair_mix, quality_fm, quality_rules, quartile_digest, suffix_dedup, toxicity, url_filter
from deliverylens.llm.components import _large_star, _small_star, components
from deliverylens.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ord long, bytes string, th int"


def odd_texts():
    draw = random.Random(4)
    words = ["".join(draw.choices("abcdeé", k=draw.randint(1, 7))) for _ in range(60)]
    base = " ".join(draw.choices(words, k=90))
    passage = " ".join(draw.choices(words, k=30))
    out = [None, "", " \n\t ", "one two", "one  TWO", "a" * 400, "a" * 400, "b" * 3000, base, base, base.upper(), base + " x"]
    for i in range(25):
        part = base.split()
        for _ in range(i % 9):
            part[draw.randrange(len(part))] = draw.choice(words)
        out.append(" ".join(part))
    out += [" ".join(draw.choices(words, k=40)) + " " + passage + "\n" + " ".join(draw.choices(words, k=20)) for _ in range(12)]
    out += ["line\nline\nline two\n" + passage, "日本語 " * 30, "x\x00y " * 20, passage * 40]
    return out


@pytest.fixture(scope="module")
def rows():
    texts = odd_texts()
    found = [(100 - i, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, len(t) if t else None, 7, "other", 1) for i, t in enumerate(texts)]
    return found + [(None, texts[8], None, None, None, None, None, None), found[9], (60, "a text with a used number " * 4, "en", "s1", 5, 1, "x", 2)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def number(i):
    return common.NO_ID if i is None else i


def brute_cut(rows):
    """Kept bytes of every row by all 50-byte windows."""
    first = {}
    for r in rows:
        b = (r[1] or "").encode()
        for p in range(len(b) - 49):
            w = b[p : p + 50]
            first[w] = min(first.get(w, common.NO_ID), number(r[0]))
    out = []
    for r in rows:
        b = (r[1] or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < number(r[0]):
                gone[p : p + 50] = b"\1" * 50
        spans = sum(1 for j, g in enumerate(gone) if g and not (j and gone[j - 1]))
        out.append((r[0], len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def as_sorted(found):
    return sorted(found, key=lambda x: tuple((v is not None, v) for v in x))


def test_suffix_dedup_cuts_what_brute_force_cuts(docs, rows):
    got = [(r.rest.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.find_repeats(docs).collect()]
    assert as_sorted(got) == as_sorted(brute_cut(rows))


def test_suffix_dedup_with_leading_bytes_that_fill_several_buckets(spark, monkeypatch):
    passage = "one very common passage that very many documents share in full, word by word"
    rows = [(i, f"{i} own start {i * i} {passage} own end {i * 7} {i}", None, None, None, None, None, None) for i in range(150)]
    monkeypatch.setattr(suffix_dedup, "parts_for", lambda *a: 40)
    got = [(r.rest.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.find_repeats(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()]
    assert as_sorted(got) == as_sorted(brute_cut(rows))


@pytest.mark.parametrize("most_ranges", [1, 3])
def test_suffix_dedup_with_fewer_ranges_than_buckets(spark, docs, rows, monkeypatch, most_ranges):
    monkeypatch.setattr(suffix_dedup, "parts_for", lambda *a: 11)
    monkeypatch.setattr(suffix_dedup, "MAX_RANGES", most_ranges)
    got = [(r.rest.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.find_repeats(docs).collect()]
    assert as_sorted(got) == as_sorted(brute_cut(rows))


def test_suffix_dedup_keeps_replacement_characters_and_dotted_names(spark):
    shared = "x" + "\u00e9" * 40  # a cut of 50-byte strings ends inside a character
    table = spark.createDataFrame([(1, shared, "a"), (2, "\ufffd y" + shared[:30] + "\u00e8 \ufffd", "b")], "doc_id long, text string, `a.b` string")
    got = {r["doc_id"]: (r["text"], r["a.b"]) for r in suffix_dedup.strip_repeats(table).collect()}
    assert got[1] == (shared, "a")
    rest = brute_cut([(1, shared), (2, "\ufffd y" + shared[:30] + "\u00e8 \ufffd")])[1][4].decode("utf-8", "ignore")
    assert got[2] == (rest, "b") and rest.count("\ufffd") == 2


def test_suffix_dedup_texts_and_empty_table(docs, empty):
    cut = suffix_dedup.strip_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    assert suffix_dedup.find_repeats(empty).count() == 0


def test_multikey_quicksort_sorts(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 8)
    draw = np.random.default_rng(0)
    keys = suffix_dedup.words(draw.integers(0, 3, (5000, 20), np.uint8))
    got = keys[suffix_dedup.multikey_quicksort(keys)]
    assert got.tolist() == sorted(keys.tolist())


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_groups(rows):
    sets = [shingle_set(r[1]) for r in rows]
    label = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= 75 * len(a | b) and label[i] != label[j]:
            old, new = label[j], label[i]
            label = [new if x == old else x for x in label]
    low = {}
    for i, r in enumerate(rows):
        low[label[i]] = min(low.get(label[i], common.NO_ID), number(r[0]))
    plain = {common.NO_ID: None}
    return [(r[0], len(sets[i]), plain.get(low[label[i]], low[label[i]]), number(r[0]) == low[label[i]]) for i, r in enumerate(rows)]


def test_near_dedup_finds_the_groups_of_brute_force(docs, rows, empty):
    assert as_sorted(map(tuple, near_dedup.near_duplicates(docs).collect())) == as_sorted(brute_groups(rows))
    kept = near_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r[3] for r in brute_groups(rows))
    assert near_dedup.near_duplicates(empty).count() == 0


def test_near_dedup_of_a_group_around_the_threshold(spark, monkeypatch):
    """Hundreds of edits of one text, many of them linked with few others or none, in several blocks."""
    monkeypatch.setattr(near_dedup, "BLOCK", 40)
    draw = random.Random(5)
    base = [f"w{draw.randrange(5000)}" for _ in range(150)]
    rows = []
    for i in range(400):
        words = list(base)
        for k in draw.sample(range(150), draw.choice((1, 3, 5, 7, 9, 11))):
            words[k] = f"x{draw.randrange(10**9)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert as_sorted(map(tuple, near_dedup.near_duplicates(docs).collect())) == as_sorted(brute_groups(rows))


def test_least_matches_follow_the_posterior():
    bounds = [bound for _, _, bound in near_dedup.least_matches(near_dedup.LOOKS)]
    assert len(bounds) == near_dedup.HASHES // 16 and bounds == sorted(bounds)
    # The bound leaves a pair at the threshold out with a small probability only.
    n, t = near_dedup.HASHES, near_dedup.NUMERATOR / near_dedup.DENOMINATOR
    missed = sum(math.comb(n, j) * t**j * (1 - t) ** (n - j) for j in range(bounds[-1]))
    assert missed < 0.01


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(1, 30)] + [(100, 100)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(21), 0), **dict.fromkeys(range(100, 130), 100)}


def test_near_dedup_asks_little_of_the_driver(spark, docs, capsys):
    edges = spark.createDataFrame([(i + 1, i) for i in range(50)], "u long, v long")
    for df in (_small_star(_large_star(edges)), near_dedup.drop_near_duplicates(docs)):
        df.explain()
        assert "Broadcast" not in capsys.readouterr().out
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    assert components(edges).count() == 51
    assert len(set(tracker.getJobIdsForGroup(None)) - before) <= 60


def test_quality_classifier_on_held_out_rows(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    scored = QUERIES["op3_quality_classifier"](spark, "/root/testdata/sf0.01").collect()
    held = [(r.predicted, labels[r.doc_id]) for r in scored if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in scored)
    assert sum(p == y for p, y in held) >= 0.95 * len(held)


def test_pair_term_is_the_sum_over_pairs():
    draw = np.random.default_rng(1)
    fm = quality_fm.Machine(0.3, draw.normal(size=quality_fm.WIDTH), draw.normal(size=(quality_fm.WIDTH, 3)))
    place, value = np.array([3, 8, 20]), np.array([0.5, 1.0, 2.0])
    pairs = sum(fm.v[a] @ fm.v[b] * x * y for (a, x), (b, y) in itertools.combinations(zip(place, value), 2))
    assert fm.raw(place, value, np.array([0]))[0][0] == pytest.approx(0.3 + fm.w[place] @ value + pairs)


def test_quality_classifier_on_odd_rows(spark, docs, empty):
    labels = spark.createDataFrame([(i, i % 2) for i in range(60, 100)] + [(99, None)], "doc_id long, quality int")
    fm = quality_fm.train(docs, labels)
    assert quality_fm.score(docs, fm).where("score between 0 and 1").count() == docs.count()
    assert quality_fm.score(empty, quality_fm.train(empty, labels)).count() == 0


def test_byte_bpe_equals_the_public_library(docs, rows, empty):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    got = [(r.rest.doc_id, list(r.ids), bytes(r.decoded)) for r in byte_bpe.encode_decode(docs, path, public_tokenizers.PATTERN).collect()]
    assert as_sorted(got) == as_sorted((r[0], library.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in rows)
    assert byte_bpe.encode_decode(empty, path, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("alphabet", ["ab", "aeiouthrnsl", "0123456789", "#!*", "éèß日"])
def test_rank_queue_merges_long_pieces(alphabet):
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    draw, queue = random.Random(alphabet), byte_bpe.RankQueue()
    texts = ["".join(draw.choices(alphabet, k=n)) for n in (1, 2, 7, 40, 5000, 3, 40)]
    got = byte_bpe.merge([text.encode() for text in texts], ranks, byte_bpe.rank_table(ranks), queue)
    assert [list(ids) for ids in got] == [library.encode_ordinary(text) for text in texts]
    assert queue.top == 0 and not queue.buckets


def test_plain_ranges_split_as_the_public_pattern():
    assert byte_bpe.PUBLIC == public_tokenizers.PATTERN
    whole, split = regex.compile(public_tokenizers.PATTERN).findall, byte_bpe.splitter(public_tokenizers.PATTERN)
    kinds, draw = "aé0²'s \n\t\x1c\x85\xa0.,_ſ日\u2003", random.Random(5)
    texts = [a + chr(i) + b for i in range(0x260) for a in kinds for b in kinds]
    texts += ["".join(draw.choices(kinds, k=60)) for _ in range(2000)] + ["".join(draw.choices(kinds[:-2], k=60)) for _ in range(2000)]
    assert [split(text) for text in texts] == [whole(text) for text in texts]
    assert byte_bpe.splitter(r"[\s\S]+")("two words") == ["two words"]


def test_lm_contrast_equals_plain_counts(docs, rows, empty):
    got = lm_contrast.score(docs, F.col("source") == "s1").collect()
    words = [((r[1] or "").encode().lower().split(), r[3] == "s1") for r in rows]
    size = len({w for ws, _ in words for w in ws}) + 2
    pairs, contexts = {True: Counter(), False: Counter()}, {True: Counter(), False: Counter()}
    for ws, mark in words:
        for a, b in zip([None, *ws], ws):
            pairs[mark][a, b] += 1
            contexts[mark][a] += 1
    scale = sum(contexts[True].values()) / sum(contexts[False].values())
    add, want = lm_contrast.ADD, []
    for r, (ws, _) in zip(rows, words):
        t = b = 0.0
        for x, y in zip([None, *ws], ws):
            t -= math.log2((pairs[True][x, y] + add) / (contexts[True][x] + add * size))
            b -= math.log2((pairs[False][x, y] * scale + add) / (contexts[False][x] * scale + add * size))
        want.append((number(r[0]), round((t - b) / len(ws), 9) if ws else None))
    assert as_sorted((number(r.doc_id), None if r.score is None else round(r.score, 9)) for r in got) == as_sorted(want)
    assert lm_contrast.score(empty, F.lit(True)).count() == 0


def test_lm_contrast_counts_every_word(spark):
    n, rows = 40_000, []
    for d in range(200):  # rare words, some shared by target and background
        first = (d // 2 - d % 2 * (d // 2 % 2)) * n // 100
        rows.append((d, " ".join(f"w{(first + i * (1 + d % 3)) % n}" for i in range(n // 100)), d % 5 == 0))
    rows.append((200, " ".join(f"w{i}" for i in range(n)), False))
    pairs, contexts = {True: Counter(), False: Counter()}, {True: Counter(), False: Counter()}
    for _, text, mark in rows:
        ws = text.split()
        pairs[mark].update(zip([None, *ws], ws))
        contexts[mark].update([None, *ws[:-1]])
    size, add = n + 2, lm_contrast.ADD
    scale = sum(contexts[True].values()) / sum(contexts[False].values())
    want = {}
    for d, text, _ in rows:
        ws = text.split()
        t = sum(math.log2((contexts[True][x] + add * size) / (pairs[True][x, y] + add)) for x, y in zip([None, *ws], ws))
        b = sum(math.log2((contexts[False][x] * scale + add * size) / (pairs[False][x, y] * scale + add)) for x, y in zip([None, *ws], ws))
        want[d] = (t - b) / len(ws)
    got = lm_contrast.score(spark.createDataFrame(rows, "doc_id long, text string, target boolean"), F.col("target")).collect()
    assert len(got) == len(rows) and all(abs(r.score - want[r.doc_id]) < 1e-8 for r in got)


def test_digest_chain_follows_descending_ids(docs, rows, empty):
    order = sorted(rows, key=lambda r: (-r[0] if r[0] is not None else math.inf, (r[1] or "").encode()))
    want = []
    for r, following in zip(order, order[1:] + order[:1]):
        text = quartile_digest.edited(r[1] or "", following[1] or "")
        want.append((r[0], len(r[1] or ""), hashlib.sha256(text.encode()).hexdigest(), quartile_digest.fingerprint((r[1] or "").encode())))
    got = quartile_digest.edit_chain(docs).collect()
    assert as_sorted((r.rest.doc_id, r.n_chars, r.edited_sha256, r.fingerprint) for r in got) == as_sorted(want)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert quartile_digest.edit_chain(empty).count() == 0


def test_digest_likeness_tells_edits_from_strangers(spark):
    got = QUERIES["op6_quartile_digest"](spark, SF_DIR).collect()
    assert np.mean([r.near_edited > r.near_next for r in got]) > 0.98


def test_rule_counts_and_base(docs, rows, spark, empty):
    labels = spark.createDataFrame([(i, i % 2) for i in range(60, 100)], "doc_id long, quality int")
    want = []
    for r in rows:
        text = r[1] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        times, hit = Counter(zip(w, w[1:], w[2:])), set()
        for i in range(len(w) - 2):
            if times[tuple(w[i : i + 3])] > 1:
                hit.update((i, i + 1, i + 2))
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want.append((r[0], len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w)))
    got = quality_rules.judge(docs, labels).select("rest.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert as_sorted(map(tuple, got.collect())) == as_sorted(want)
    assert quality_rules.judge(empty, labels).count() == 0


def test_binomial_bound_is_exact():
    for k, n, error in ((0, 100, 0.05), (3, 50, 0.01), (10, 2000, 0.001)):
        p = quality_rules.upper_bound(k, n, error)
        assert sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1)) == pytest.approx(error, rel=1e-6)
    assert quality_rules.upper_bound(5, 5, 0.05) == 1.0


def test_cutoffs_respect_the_risk():
    good, bad = np.zeros(101, np.int64), np.zeros(101, np.int64)
    good[0], good[20], bad[60] = 20000, 20, 300
    cut = quality_rules.choose({("en", "symbols"): (good, bad)}, 1)
    assert cut["en", "symbols"] < 0.6
    assert quality_rules.choose({("en", "symbols"): (good // 2000, bad)}, 1) == {}


def test_every_stratum_gets_its_own_cutoffs(spark):
    plain, marked = (" ".join(f"word{i}{end}" for i in range(60)) for end in ("", "!!"))
    rows, labels, i = [], [], 0
    for stratum in range(60):  # what is good in the last stratum is bad in the others
        for good in [1] * (1000 if stratum > 50 else 1100) + [0] * 20:
            rows.append((i, marked if (stratum == 59) == bool(good) else plain, f"l{stratum:02}"))
            labels.append((i, good))
            i += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    judged = quality_rules.judge(docs, spark.createDataFrame(labels, "doc_id long, quality int"), error=0.9, risk=0.5)
    lost = {r["stratum"]: r for r in judged.groupBy("stratum").agg(F.sum((~F.col("kept")).cast("int")).alias("n"), F.count("*").alias("all")).collect()}
    assert len(lost) == 60 and sum(r["all"] for r in lost.values()) == i
    assert lost["l59"]["n"] == 0 and all(lost[f"l{s:02}"]["n"] == 20 for s in range(59))


def test_url_filter_matches_duckdb(spark, con):
    assert differences(QUERIES["op8_url_filter"](spark, SF_DIR), con, ORACLES["op8_url_filter"]) == []


def test_url_filter_on_odd_urls(spark):
    urls = ["http://A.example.NET/en/1", "http://x.example.net", "http://y.net/fr/", "https://b.org/fr/1?x=/en/", "http://b.org?x", "no host", None, "://", "http://net/a", "ftp://bad.example.com/a/", "http://www.bad.example.com/a", "http://notexample.com/de/1"]
    pages = spark.createDataFrame([(i, u, "block") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    listed = spark.createDataFrame([("http://bad.example.com/a",), (None,)], "url string")
    got = {r.page.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, listed).collect()}
    assert got == {
        0: ("a.example.net", "/en/1", "example.net/en/", "allow"),
        1: ("x.example.net", "", None, "allow"),
        2: ("y.net", "/fr/", "net/", "block"),
        3: ("b.org", "/fr/1", "org/fr/", "allow"),
        4: ("b.org", "", None, "allow"),
        5: ("", "", None, "allow"),
        6: ("", "", None, "allow"),
        7: ("", "", None, "allow"),
        8: ("net", "/a", "net/", "block"),
        9: ("bad.example.com", "/a/", None, "block"),
        10: ("www.bad.example.com", "/a", None, "block"),
        11: ("notexample.com", "/de/1", None, "allow"),
    }
    assert url_filter.judge(pages.limit(0), listed.limit(0)).count() == 0


def test_pfair_schedule_stays_within_one_block():
    weights = {"a": 5.0, "b": 3.0, "c": 1.5, "d": 0.5}
    share = pfair_mix.shares(weights, 1000)
    slots = pfair_mix.one_period(share, 1000)
    assert sorted(t for s in slots.values() for t in s) == list(range(1000))
    for s, a in share.items():
        for t in range(1001):
            assert abs(sum(x < t for x in slots[s]) - a * t / 1000) < 1


def test_pfair_follows_exact_weights_over_long_phases():
    sizes = {"hot": 5_000_000, **{f"s{i:02}": 500_000 for i in range(20)}, "rare": 300}
    for weights in ({s: n**0.5 for s, n in sizes.items()}, {s: 1 / 3 if s == "hot" else 1e-4 if s == "rare" else 0.7 for s in sizes}):
        blocks = {s: -(-n // 64) for s, n in sizes.items()} | {"rare": 5000}
        exact = {s: Fraction(w) / sum(map(Fraction, weights.values())) for s, w in weights.items()}
        phase = min(int(n / exact[s]) for s, n in blocks.items())
        assert phase > 40_000
        taken = dict.fromkeys(sizes, 0)
        for t, (s, block, slot) in enumerate(itertools.islice(pfair_mix.schedule(blocks, weights), phase), 1):
            assert (block, slot) == (taken[s], t - 1)
            taken[s] += 1
            if t % 97 == 0 or t == phase:
                assert all(abs(taken[x] - exact[x] * t) < 1 for x in sizes)
    found = list(pfair_mix.schedule({"a": 7, "b": 1, "c": 30}, {"a": 2.0, "b": 5.0, "c": 0.1}))
    assert sorted((s, k) for s, k, _ in found) == sorted((s, k) for s, n in (("a", 7), ("b", 1), ("c", 30)) for k in range(n))
    assert [slot for *_, slot in found] == list(range(38))


def test_pfair_places_every_row_once(docs, empty):
    mixed = pfair_mix.mix(docs, block=4)
    found = mixed.collect()
    assert len(found) == docs.count() and len({r.place for r in found}) == len(found)
    used = {(r.source or "", r.source_block): r.slot for r in found}
    assert len(set(used.values())) == len(used)
    assert pfair_mix.in_order(docs, block=4).columns == docs.columns
    assert pfair_mix.mix(empty).count() == 0


def test_pfair_collects_no_row_per_source(docs, monkeypatch):
    kind, sizes = type(docs), []
    plain = kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: sizes.append(len(got := plain(self))) or got)
    pfair_mix.mix(docs.withColumn("source", F.col("doc_id").cast("string")), block=4).count()
    assert max(sizes, default=0) <= 1


def test_toxicity_on_held_out_rows(spark):
    data = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = toxicity.train(docs, labels, learn=~held)
    got = toxicity.score(docs.join(labels.where(held).drop("quality"), "doc_id"), model).select("score", "rest.toxic").collect()
    flagged = [r.toxic for r in got if r.score >= 0.5]
    assert sum(flagged) >= 0.9 * len(flagged) and sum(flagged) >= 0.6 * sum(r.toxic for r in got)


def test_toxicity_on_odd_rows(spark, docs, empty):
    labels = spark.createDataFrame([(i, i % 2) for i in range(60, 100)] + [(60, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert toxicity.score(docs, model).where("score between 0 and 1").count() == docs.count()
    assert toxicity.score(empty, toxicity.train(empty, labels.limit(0))).count() == 0
    untaught = toxicity.train(empty, labels)  # labels of documents that are not there
    assert toxicity.score(docs, untaught).where("score < 1e-12").count() == docs.count()


def test_toxicity_windows_cover_long_words():
    word = bytes(random.Random(2).choices(range(97, 123), k=1000))
    for n in (1, 31, 32, 33, 47, 48, 49, 64, 1000):
        windows = toxicity.words_of(word[:n])
        assert all(len(w) <= toxicity.PIECE for w in windows)
        places = [word[:n].index(w) for w in windows]
        assert {i for p, w in zip(places, windows) for i in range(p, p + len(w))} == set(range(n))
    # Any string of half a piece is whole in some window.
    assert all(any(word[i : i + 16] in w for w in toxicity.words_of(word)) for i in range(len(word) - 15))


def test_toxic_string_deep_in_a_long_word_is_learned(spark):
    draw = random.Random(5)
    stem = lambda n: "".join(draw.choices("abcdefgh", k=n))
    rows = [(i, " ".join(stem(draw.randint(3, 8)) for _ in range(20)) + " " + stem(64) + ("xyzzyqqk" if i % 2 else stem(8)) + stem(40)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int"))
    assert b"xyzzyqqk" in model.toxic and b"xyzzyqqk" not in model.ordinary
    gains = toxicity.Gains(model.toxic, model.ordinary)
    windows = [w for _, text in rows[201::2] for w in toxicity.words_of(text.encode()) if w.startswith(b"xyzzyqqk")]
    assert len(windows) == 50 and np.mean([gains.of(w) > 0 for w in windows]) > 0.9


def test_short_toxic_words_gain(spark):
    draw, marks = random.Random(6), ["zurk", "quoxy", "vixzon"]
    words = ["".join(draw.choices("abcdefghi", k=draw.randint(2, 9))) for _ in range(400)]
    rows = [(i, " ".join(draw.choices(words, k=40) + draw.choices(marks, k=2) * (i % 2) + draw.choices(words, k=40))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, toxic int"))
    gains = toxicity.Gains(model.toxic, model.ordinary)
    assert all(gains.of(mark.encode()) > 2 for mark in marks)
    held = [(r.score >= 0.5) == r.rest.doc_id % 2 for r in toxicity.score(docs.where("doc_id >= 300"), model).collect()]
    assert np.mean(held) > 0.95


def test_names_of_extra_columns_do_not_clash(spark):
    rows = [(i, f"word{i} and others {i % 7}", f"s{i % 3}", i, -i, 5, "x") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, place long, Slot long, slot_ int, `a.b` string")
    mixed = pfair_mix.mix(docs)
    assert mixed.columns == [*docs.columns, "source_block", "slot__", "place_"]
    got = mixed.collect()
    assert sorted(tuple(r)[:7] for r in got) == rows and len({r.place_ for r in got}) == 40
    assert sorted(tuple(r) for r in pfair_mix.in_order(docs).collect()) == rows
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    for kept in (quality_fm.score(docs, quality_fm.train(docs, labels)), toxicity.score(docs, toxicity.train(docs, labels))):
        assert sorted((r.rest["doc_id"], r.rest["a.b"], r.rest["place"]) for r in kept.collect()) == [(r[0], "x", r[3]) for r in rows]


def test_pipeline_rows(spark):
    import corpus_pipeline

    got = corpus_pipeline.run(spark, SF_DIR).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert len(got) == len({r.doc_id for r in got}) and all(r.round_trip and r.n_tokens == len(r.ids) for r in got)
    bad = {r.doc_id for r in QUERIES["op3_quality_classifier"](spark, SF_DIR).collect() if not r.predicted}
    left = [(i, r.text) for i, r in docs.items() if i not in bad]
    groups = brute_groups([(i, t) for i, t in left])
    assert {r.doc_id for r in got} == {g[0] for g in groups if g[3]}


def test_pipeline_places_and_ids_equal_brute_force(spark):
    import corpus_pipeline

    got = corpus_pipeline.run(spark, SF_DIR).collect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumn("h", F.xxhash64(F.lit(9), "doc_id")).collect()
    bad = {r.doc_id for r in QUERIES["op3_quality_classifier"](spark, SF_DIR).collect() if not r.predicted}
    groups = brute_groups([(r.doc_id, r.text) for r in docs if r.doc_id not in bad])
    first = {g[0] for g in groups if g[3]}
    left = [r for r in docs if r.doc_id in first]
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    texts = {i: kept.decode(errors="ignore") for i, *_, kept in brute_cut([(r.doc_id, r.text) for r in left])}
    assert {r.doc_id: list(r.ids) for r in got} == {i: library.encode_ordinary(t) for i, t in texts.items()}
    sources = {}
    for r in sorted(left, key=lambda r: (r.h, r.doc_id)):
        sources.setdefault(r.source or "", []).append(r.doc_id)
    blocks = {s: -(-len(ids) // 64) for s, ids in sources.items()}
    want = {}
    for s, k, slot in pfair_mix.schedule(blocks, {s: len(ids) ** 0.5 for s, ids in sources.items()}):
        want.update({i: slot * 64 + j for j, i in enumerate(sources[s][64 * k : 64 * k + 64])})
    assert {r.doc_id: r.place for r in got} == want
