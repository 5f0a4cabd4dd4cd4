"""Each operator against brute force, and on awkward rows: nulls, empty and long texts, ties, repeats, empty tables and
columns with clashing names."""

import hashlib
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import same
from pyspark.sql import functions as F

from shardloom.llm import bpe, common, decontaminate, licenses, lm, mil, minhash, registry, simhash, substrings, units

LONG = " ".join(f"w{i % 997}x" for i in range(30_000))
PASSAGE = " ".join(f"passage{i}" for i in range(60))
AWKWARD = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (4, "one"), (5, "MIT License\nand the GNU General Public License."), (6, LONG), (7, LONG), (8, LONG + " tail"), (None, "no id at all here"), (None, None),
    (9, PASSAGE + "\nown words nine"), (10, "own words ten\n" + PASSAGE), (100, "日本語 テスト 😀 éè ß İstanbul K"), (200, "<|endoftext|> a<|startoftext|>b"), (12, "x" * 5000),
]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame([(i, t, "l", 1.0, 2, "u") for i, t in AWKWARD], "doc_id long, text string, lang string, score double, ids int, n_units string")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


# --- 1 fingerprints -------------------------------------------------------------------------------------------------


def test_edited_texts(spark, sf, texts):
    rows = {r.doc_id: r for r in simhash.op1_simhash(spark, sf).collect()}
    order = sorted(texts, reverse=True)
    assert len(rows) == len(texts)
    for i, d in enumerate(order):
        t, following = texts[d], texts[order[(i + 1) % len(order)]]
        half = len(t) // 2
        assert rows[d].n_chars == len(t)
        assert rows[d].edited_sha256 == hashlib.sha256((t[: len(t) - half] + following[:half]).encode()).hexdigest()
        a, b = int(rows[d].fingerprint, 16), int(rows[order[(i + 1) % len(order)]].fingerprint, 16)
        assert rows[d].near_next == 1 - (a ^ b).bit_count() / 128
        assert rows[d].near_edited == 1 - (a ^ int(rows[d].edited_fingerprint, 16)).bit_count() / 128
    apart = [r for d, r in rows.items()]
    assert np.mean([r.near_edited for r in apart]) > np.mean([r.near_next for r in apart]) + 0.05
    equal = {}
    for d, r in rows.items():
        assert equal.setdefault(texts[d], r.fingerprint) == r.fingerprint


def test_votes_by_hand(spark):
    """The votes of each bit, from the hashes themselves."""
    df = spark.createDataFrame([(1, "a b c d e f a b c d e"), (2, "a b")], "doc_id long, text string")
    got = {r.doc_id: (r.f1, r.f2) for r in simhash.fingerprints(df).collect()}
    hashed = simhash.terms(df, "text", ["doc_id"]).collect()
    for d in (1, 2):
        own = [(r.h1 % 2**64, r.h2 % 2**64) for r in hashed if r.doc_id == d]
        want = [sum(1 << j for j in range(64) if 2 * sum(h[k] >> j & 1 for h in own) > len(own)) for k in (0, 1)]
        assert [f % 2**64 for f in got[d]] == want
    assert len([r for r in hashed if r.doc_id == 1]) == 7


@pytest.mark.parametrize(("radius", "blocks"), [(3, 4), (3, 8), (0, 1), (5, 8)])
def test_block_tables_find_all(spark, radius, blocks):
    r = np.random.default_rng(radius + blocks)
    base = [int.from_bytes(r.bytes(16), "big") for _ in range(6)]
    some = set()
    for b in base:
        for _ in range(12):
            flips = r.choice(128, r.integers(0, 8), replace=False)
            x = b
            for f in flips:
                x ^= 1 << int(f)
            some.add(x)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    rows = [(signed(x >> 64), signed(x & (1 << 64) - 1)) for x in sorted(some)]
    index = spark.createDataFrame(rows, "f1 long, f2 long")
    got = {(x.q1, x.q2, x.f1, x.f2, x.distance) for x in simhash.near(index.withColumnsRenamed({"f1": "q1", "f2": "q2"}), index, radius, blocks).collect()}
    bits = lambda a, b: ((a[0] ^ b[0]) % 2**64).bit_count() + ((a[1] ^ b[1]) % 2**64).bit_count()
    assert got == {(*a, *b, bits(a, b)) for a in rows for b in rows if bits(a, b) <= radius}


@pytest.mark.parametrize(("radius", "blocks"), [(9, 8), (12, 16), (simhash.RADIUS, simhash.BLOCKS)])
def test_wide_radius_finds_all(spark, radius, blocks):
    """Also where every block differs."""
    r = np.random.default_rng(radius)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    some = []
    for _ in range(4):
        base = int.from_bytes(r.bytes(16), "big")
        some.append(base)
        for n in [*range(radius - 4, radius + 3)] * 3:
            some.append(base ^ sum(1 << int(j) for j in r.choice(128, n, replace=False)))
        even = [16 * b + int(j) for b in range(8) for j in r.choice(16, -(-radius // 8), replace=False)]
        some.append(base ^ sum(1 << j for j in r.permutation(even)[:radius].tolist()))
    rows = [(signed(x >> 64), signed(x & (1 << 64) - 1)) for x in some]
    index = spark.createDataFrame(rows, "f1 long, f2 long")
    queries = spark.createDataFrame(rows[:1], "q1 long, q2 long")
    got = {(x.f1, x.f2): x.distance for x in simhash.near(queries, index, radius, blocks).collect()}
    want = {row: n for row, x in zip(rows, some, strict=True) if (n := (x ^ some[0]).bit_count()) <= radius}
    assert got == want and radius in want.values()


def test_near_copies_are_counted(spark, tmp_path):
    """Texts of similarity 0.8 to 0.9 are within the query's radius."""
    w = [f"w{i}" for i in range(600)]
    rows = [(100, " ".join(w))] + [(101 + k, " ".join([*[f"n{k}x{i}" for i in range(30 + 3 * k)], *w[30 + 3 * k :]])) for k in range(10)] + [(1, "other text that is far away from these")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = {r.doc_id: r.n_near for r in simhash.op1_simhash(spark, str(tmp_path)).collect()}
    assert found.pop(100) == 10 and set(found.values()) == {None}


@pytest.mark.parametrize("size", [10**9, 100_000, 60, 1])
def test_neighbours_in_any_buckets(spark, awkward, size):
    got = simhash.with_next(awkward, size).where("not last").collect()
    order = sorted([(i, t or "") for i, t in AWKWARD], key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
    want = Counter((*o, order[(k + 1) % len(order)][1]) for k, o in enumerate(order))
    assert Counter((r.doc_id, r.text, r.next_text) for r in got) == want


def test_buckets_follow_bytes(spark):
    """However many rows there are, and wherever their ids lie, a bucket holds about so many bytes."""
    ids = [*range(500), *range(10**12, 10**12 + 500, 7), -(2**63), 2**63 - 1]
    df = spark.createDataFrame([(i, f"text {i % 13} ".ljust(84, "x")) for i in ids], "doc_id long, text string")
    rows = simhash.with_next(df, 1000).collect()
    held = Counter(r.bucket for r in rows if not r["last"])
    assert max(held.values()) <= 11 and len(held) >= len(ids) // 11
    order = sorted(ids, reverse=True)
    text = {i: f"text {i % 13} ".ljust(84, "x") for i in ids}
    assert {(r.doc_id, r.next_text) for r in rows if not r["last"]} == {(d, text[order[(k + 1) % len(order)]]) for k, d in enumerate(order)}


def test_fingerprints_of_awkward_rows(spark, awkward, none):
    rows = simhash.edited_fingerprints(awkward).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1 for r in rows)
    assert simhash.edited_fingerprints(none).count() == 0
    single = simhash.edited_fingerprints(spark.createDataFrame([(None, "a b c")], "doc_id long, text string")).first()
    assert single.near_next == 1.0
    assert simhash.fingerprints(awkward).count() == len(AWKWARD)


# --- 2 BPE ----------------------------------------------------------------------------------------------------------


def test_bpe_is_the_librarys(spark, awkward, docs):
    from tokenizers import Tokenizer

    ref = Tokenizer.from_file(bpe.default_path())
    both = awkward.select("doc_id", "text").union(docs)
    seen = 0
    for r in both.withColumn("e", bpe.encoder(spark)("text")).collect():
        want = ref.encode(r.text or "", add_special_tokens=False).ids
        assert r.e.ids == want and r.e.n_tokens == len(want)
        assert r.e.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in want)).hexdigest()
        assert r.e.decoded_sha256 == hashlib.sha256(ref.decode(want, skip_special_tokens=False).encode()).hexdigest()
        seen += 1
    assert seen == len(AWKWARD) + docs.count()


def test_merges_in_order_of_rank():
    t = bpe.Tokenizer(open(bpe.default_path(), "rb").read())

    def plain(ids):
        while found := [(t.merges[p][0], i) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in t.merges]:
            _, i = min(found)
            ids = [*ids[:i], t.merges[ids[i], ids[i + 1]][1], *ids[i + 2 :]]
        return ids

    for w in ("abracadabra", "aaaaaaaaaaaaa", "mississippi" * 3, "thethethe"):
        ids = [t.ids[c] for c in w[:-1]] + [t.ids[w[-1] + "</w>"]]
        assert t.merge([*ids]) == plain(ids)


def test_bpe_keeps_other_columns(awkward, none, spark):
    out = bpe.encode(awkward)
    assert out.columns == ["doc_id", "text", "lang", "score", "n_units", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    assert out.count() == len(AWKWARD) and bpe.encode(none).count() == 0
    back = out.where("doc_id = 5").select(bpe.decoder(spark)("ids").alias("t")).first().t
    assert back == "mit</w> license</w> and</w> the</w> gn u</w> general</w> public</w> license</w> .</w>"


# --- 3 quality, 7 toxicity ------------------------------------------------------------------------------------------


def crc(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode())


@pytest.mark.parametrize(("name", "label", "parts", "held", "least"), [("op3_quality", "quality", 4, 2, 0.9), ("op7_toxicity", "toxic", 5, 0, 0.75)])
def test_held_out_accuracy(spark, name, label, parts, held, least):
    big = "/root/testdata/sf0.01"
    rows = registry.queries()[name](spark, big).collect()
    assert len(rows) == 1000 and all(r.held_out == (crc(r.doc_id) % parts == held) for r in rows)
    y = {r.doc_id: r[label] for r in spark.read.parquet(f"{big}/labels.parquet").collect()}
    told = [(r.score, y[r.doc_id]) for r in rows if r.held_out and r.doc_id in y]
    ones, zeros = [s for s, v in told if v == 1], [s for s, v in told if v == 0]
    assert np.mean([(a > b) + 0.5 * (a == b) for a in ones for b in zeros]) > least
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= (0.7 if label == "quality" else 0.5)) for r in rows)


def test_labels_of_held_out_rows_are_never_read(spark, sf):
    """Turning their labels about changes nothing."""
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    for fit, label, parts, held in ((mil.fit_quality, "quality", 4, 2), (mil.fit_toxicity, "toxic", 5, 0)):
        h = F.crc32(F.col("doc_id").cast("string")) % parts == held
        turned = labels.withColumn(label, F.when(h, 1 - F.col(label)).otherwise(F.col(label)))
        a, b = fit(docs, labels), fit(docs, turned)
        for text in ("some words", "you idiot moron", "###"):
            one = lambda m: m.scores([mil.Passages().vectors(text)])[0] if label == "quality" else m.score(text)[0]  # noqa: B023, E731
            assert one(a) == one(b)


def bags_of(seed, n=9, d=5):
    r = np.random.default_rng(seed)
    bags = [r.standard_normal((int(k), d)) for k in r.integers(1, 6, n)]
    sizes = np.array([len(b) for b in bags])
    return bags, np.concatenate(bags), np.cumsum(sizes) - sizes, np.repeat(np.arange(n), sizes), r.integers(0, 2, n).astype(float)


def wide_model(x, d=5):
    m = mil.GatedAttention(seed=3, hidden=4, gate=3)
    m.mean, m.scale = x.mean(0), x.std(0)
    m.start(d)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    return m


def test_gated_attention_by_hand():
    """The forward pass against loops over passages."""
    bags, x, starts, bag, _ = bags_of(1)
    m = wide_model(x)
    p = m.p
    for b, got in zip(bags, m.scores(bags), strict=True):
        hs = [[np.tanh(sum((v[i] - m.mean[i]) / m.scale[i] * p["W"][i, k] for i in range(5)) + p["b"][k]) for k in range(4)] for v in b]
        e = [sum(p["a"][g] * np.tanh(sum(h[k] * p["V"][k, g] for k in range(4))) / (1 + np.exp(-sum(h[k] * p["U"][k, g] for k in range(4)))) for g in range(3)) for h in hs]
        a = [np.exp(v) / sum(map(np.exp, e)) for v in e]
        z = [sum(w * h[k] for w, h in zip(a, hs)) for k in range(4)]
        assert got == pytest.approx(1 / (1 + np.exp(-(sum(z[k] * p["c"][k] for k in range(4)) + p["d"][0]))))


def test_gradients_by_differences():
    _, x, starts, bag, y = bags_of(2)
    m = wide_model(x)

    def loss():
        logit = m.forward(x, starts, bag)[-1]
        return np.mean(np.logaddexp(0, logit) - y * logit)

    found = m.gradients(x, starts, bag, y)
    for k, v in m.p.items():
        for at in np.ndindex(v.shape):
            was, e = v[at], 1e-6
            v[at] = was + e
            up = loss()
            v[at] = was - e
            down = loss()
            v[at] = was
            assert found[k][at] == pytest.approx((up - down) / (2 * e), abs=1e-7), (k, at)


def test_words_glued_to_sentence_ends_count_alike():
    """A text is looked up as it is cut: the quick look finds a term wherever the cut does."""
    m = mil.NoisyOr(["moron", "^idi"])
    m.w = np.array([9.0, 9.0])
    assert m.text_terms("you.moron!")[1] == [(4, 9, [0])] and m.score("end.idiot")[0] > 0.5
    assert mil.distinct_words(pa.array(["you.moron!x"])).to_pylist() == [sorted({"you", "moron", "^mor", "^moro", "x"})]
    r = np.random.default_rng(5)
    for _ in range(400):
        text = "".join(r.choice(["moron", "idiot", "fine", ".", "!", "?", "\n", " ", "(", "é", "\u2003"], int(r.integers(0, 9))))
        plain, found = 0, []
        for a, b in mil.sentences(text):
            held = sorted({m.terms[f] for w in text[a:b].lower().split() for f in mil.features(w) if f in m.terms})
            found += [(a, b, held)] if held else []
            plain += not held
        assert m.text_terms(text) == (plain, found), text


def test_training_separates_bags():
    """Training separates bags by one telling passage."""
    r = np.random.default_rng(0)
    bags = [r.standard_normal((int(n), 6)).astype(np.float32) for n in r.integers(1, 9, 300)]
    y = np.array([i % 2 for i in range(300)], np.float32)
    for b, v in zip(bags, y, strict=True):
        if v:
            b[r.integers(len(b))] += 4
    m = mil.GatedAttention().fit(bags, y)
    assert ((m.scores(bags) >= 0.5) == y).mean() > 0.95


def test_noisy_or_is_the_product():
    m = mil.NoisyOr(["bad", "^wor"])
    m.w, m.b = np.array([5.0, 2.0]), -3.0
    score, bad = m.score("So bad. Fine here! Worse, worst? ")
    p = [1 / (1 + np.exp(-x)) for x in (2.0, -3.0, -1.0)]
    assert score == pytest.approx(1 - np.prod([1 - x for x in p])) and [(a, b) for a, b, _ in bad] == [(0, 6)]


def test_scores_of_awkward_rows(spark, awkward, none):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (4, 1, 1), (5, 0, 0), (6, 1, 0), (9, None, None), (None, 1, 1), (10, 0, 1)], "doc_id long, quality int, toxic int")
    empty = labels.limit(0)
    for lab in (labels, empty):
        q = mil.quality_score(spark, mil.fit_quality(awkward, lab))
        t = mil.toxicity_score(spark, mil.fit_toxicity(awkward, lab))
        rows = awkward.select("doc_id", q("text").alias("q"), t("text").alias("t")).collect()
        assert len(rows) == len(AWKWARD) and all(0 <= r.q <= 1 and 0 <= r.t.score <= 1 for r in rows)
    assert none.select(mil.quality_score(spark, mil.GatedAttention())("text")).count() == 0
    assert mil.keep_good(awkward, labels).columns == awkward.columns


# --- 4 substrings, 8 line runs --------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["op4_substrings", "op8_line_runs", "op9_decontaminate"])
@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_sql(spark, name, folder):
    same(registry.queries()[name](spark, folder), registry.oracle_sql()[name], folder)


def norm(line):
    return re.sub(r"[ \t\r\f]+", " ", line.lower()).strip(" ")


def placed(rows):
    """Rows in the order that decides first occurrences; equal rows once."""
    return [(i, t or "") for i, t in rows]


def test_units_of_awkward_rows(spark, awkward, none):
    out = substrings.dedup_units(awkward)
    rows = {(r.doc_id, r.text): r for r in out.collect()}
    assert out.count() == len(AWKWARD) and substrings.dedup_units(none).count() == 0
    kept = [r for r in rows.values() if PASSAGE in r.text]
    assert [r.doc_id for r in kept] == [9] and rows[10, "own words ten\n"].removed == [(14, 14 + len(PASSAGE))]
    assert rows[10, "own words ten\n"].removed_words == 60
    assert sorted(r.doc_id for r in rows.values() if r.text == LONG) == [6] and rows[7, ""].n_removed == 1
    assert "n_units" in out.columns and dict(out.dtypes)["n_units"] == "bigint"
    # later equal rows give way too
    twice = spark.createDataFrame([(1, PASSAGE), (1, PASSAGE), (1, PASSAGE)], "doc_id long, text string")
    assert sorted(r.text for r in substrings.dedup_units(twice).collect()) == ["", "", PASSAGE]
    assert sorted(r.text for r in units.dedup_runs(twice).collect()) == ["", "", PASSAGE]
    with pytest.raises(ValueError, match="_ll_k1"):
        substrings.dedup_units(twice.withColumn("_LL_K1", F.lit(1)))


def brute_units(rows, find, run_words, short):
    """Spans of units that go; rows in order."""
    seen, out = set(), {}
    for d, t in rows:
        cut, at = [], 0
        for u in find(t):
            p = " ".join(u.translate({i: i + 32 for i in range(65, 91)}).split(" ")).split()
            cut.append((at, at + len(u), tuple(p)))
            at += len(u)
        assert at == len(t)
        later, run, spans = [], [], []
        for a, b, p in cut:
            later.append(p in seen)
            seen.add(p)
        for (a, b, p), known in [*zip(cut, later), ((0, 0, ("end",)), False)]:
            if p and known:
                run.append((a, b, len(p)))
            elif p:
                if sum(n for _, _, n in run if n >= short) >= run_words:
                    spans += [(a, b) for a, b, _ in run]
                run = []
        out[d] = spans
    return out


@pytest.mark.parametrize("kind, pattern", [("sentence", "[^.!?\n]*[.!?\n]+|[^.!?\n]+"), ("line", "[^\n]*\n|[^\n]+")])
def test_passages_by_brute_force(spark, kind, pattern):
    """Random sentences with passages planted in the middle of lines, blank units, and repeats within a text."""
    r = np.random.default_rng(3)
    pool = ["One two three four. ", "FIVE six!", " seven eight nine ten eleven twelve?\n", "\n", "  ", "é ü ß word. ", "No. ", "thirteen fourteen fifteen sixteen "]
    rows = [(d, "".join(r.choice(pool, int(r.integers(0, 12))))) for d in range(80)]
    got = {x.doc_id: x for x in substrings.dedup_units(spark.createDataFrame(rows, "doc_id long, text string"), kind, 9).collect()}
    want = brute_units(rows, re.compile(pattern).findall, 9, substrings.SHORT)
    assert sum(map(bool, want.values())) > 9  # else this shows little
    for d, t in rows:
        assert [tuple(x) for x in got[d].removed] == want[d], (d, t)
        keep = [c for i, c in enumerate(t) if not any(a <= i < b for a, b in want[d])]
        assert got[d].text == "".join(keep)


def test_planted_passages_go_and_chance_repeats_stay(spark):
    passage = "The first of these is long enough to tell. So is the second one of the lot.\nAnd here is a third with more words in it! Last comes this one, with a few more words again."
    rows = [(1, f"Own opening words {passage} own closing words one."), (2, f"Other opening words here {passage} and other ends."), (3, "The first of these is long enough to tell. Yet this text goes on in its own way."), (None, passage)]
    got = {x.doc_id: x for x in substrings.dedup_units(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].text == rows[0][1] and got[3].text == rows[2][1] and got[1].n_removed == got[3].n_removed == 0
    assert got[2].text == "Other opening words here The first of these is long enough to tell. and other ends." and got[2].removed_words == 28
    assert got[None].n_removed == 4 and got[None].text == ""


def test_paragraphs(spark):
    df = spark.createDataFrame([(1, f"a\n\n{PASSAGE}\nx\n\nb"), (2, f"{PASSAGE.upper()}\nx\n\nc")], "doc_id long, text string")
    rows = {r.doc_id: r for r in substrings.dedup_units(df, "paragraph").collect()}
    assert rows[1].text == f"a\n\n{PASSAGE}\nx\n\nb" and rows[2].text == "c" and rows[2].removed == [(0, len(PASSAGE) + 4)]


def brute_runs(rows, min_lines, run_words):
    """Lines that go, by comparing all windows."""
    lines = {d: [(i, norm(u)) for i, u in enumerate(t.split("\n")) if norm(u)] for d, t in rows}
    gone, seen = set(), set()
    for d in sorted(lines):
        own = lines[d]
        for j in range(len(own)):
            w = tuple(x for _, x in own[j : j + min_lines])
            if len(w) == min_lines:
                if w in seen:
                    gone |= {(d, own[k][0]) for k in range(j, j + min_lines)}
                seen.add(w)
            one = own[j][1]
            if len(one.split(" ")) >= run_words:
                if (one,) in seen:
                    gone.add((d, own[j][0]))
                seen.add((one,))
    return gone


@pytest.mark.parametrize("min_lines", [1, 2, 3, 4, 5])
def test_runs_by_brute_force(spark, min_lines):
    r = np.random.default_rng(min_lines)
    rows = [(d, "\n".join(r.choice(["a", "B", "c  c", "", "d"], int(r.integers(1, 14))))) for d in range(60)]
    out = {x.doc_id: x for x in units.dedup_runs(spark.createDataFrame(rows, "doc_id long, text string"), min_lines, 99).collect()}
    gone = brute_runs(rows, min_lines, 99)
    for d, t in rows:
        parts = t.split("\n")
        assert out[d].text == "\n".join(u for i, u in enumerate(parts) if (d, i) not in gone), (d, t)
        assert [t[a:b] for a, b in out[d].removed] == [u for i, u in enumerate(parts) if (d, i) in gone]


def brute_maximal(rows, min_lines):
    """Maximal repeated runs, by growing every window while it stands anywhere else."""
    lines = {d: [norm(u) for u in t.split("\n") if norm(u)] for d, t in rows}
    out = {}
    for d, own in lines.items():
        reach = []
        for j in range(len(own)):
            n = 0
            while j + n < len(own) and any((e, k) != (d, j) and x[k : k + n + 1] == own[j : j + n + 1] for e, x in lines.items() for k in range(len(x) - n)):
                n += 1
            reach.append(n)
        out[d] = [(j, n) for j, n in enumerate(reach) if n >= min_lines and not (j and reach[j - 1] - 1 >= n)]
    return out


@pytest.mark.parametrize("min_lines", [1, 2, 3])
def test_maximal_runs_by_brute_force(spark, min_lines):
    """Shared runs of 2 to 50 lines among lines of their own, periodic runs, copies, and runs that end a text."""
    r = np.random.default_rng(min_lines)
    rows = [(d, "\n".join(r.choice(["a", "B", "c  c", "", "d"], int(r.integers(1, 14))))) for d in range(25)]
    for n in (2, 3, 7, 8, 9, 31, 50):
        shared = [f"run {n} line {i}" for i in range(n)]
        rows += [(1000 + 10 * n + k, "\n".join([f"own {n} {k}"] * (k > 0) + shared + [f"end {n} {k}"] * (k < 2))) for k in range(3)]
    rows += [(5000, "\n".join(["x"] * 37)), (5001, "\n".join(["y", "z"] * 20 + ["y"])), (5002, "\n".join(["p"] * 5)), (5003, "\n".join(["x"] * 20)), (5004, "\n".join(["p"] * 5)), (5005, "\n\n")]
    out = {x.doc_id: x for x in units.dedup_runs(spark.createDataFrame(rows, "doc_id long, text string"), min_lines, 99).collect()}
    want = brute_maximal(rows, min_lines)
    assert {d: [tuple(x) for x in out[d].runs] for d, _ in rows} == want
    gone = brute_runs(rows, min_lines, 99)
    for d, t in rows:
        assert out[d].text == "\n".join(u for i, u in enumerate(t.split("\n")) if (d, i) not in gone), (d, t)


def test_runs_of_awkward_rows(awkward, none):
    out = units.dedup_runs(awkward)
    assert out.count() == len(AWKWARD) and units.dedup_runs(none).count() == 0
    assert units.cleaned(awkward, out).columns == awkward.columns


# --- 5 language model -----------------------------------------------------------------------------------------------


def test_base_scores(spark):
    rows = [(i, " ".join(["the", "cat"] * (i % 3) + [f"w{i}", "A\x0bb", "c d"])) for i in range(40)] + [(3, "the cat"), (3, "the cat"), (50, None), (51, "  \n"), (None, "the x")]
    out = lm.score(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, score int")).collect()
    toks = lambda t: [w.decode() for w in (t or "").encode().lower().split()]
    train = [t for d, t in rows if crc(d) % 7 != 2]
    c = Counter(w for t in train for w in [*toks(t), "<end>"])
    n, v = sum(c.values()), len(c)
    want = Counter()
    for d, t in rows:
        own = [*toks(t), "<end>"]
        want[d, crc(d) % 7 == 2, len(own), sum(c[w] > 0 for w in own), n, round(sum(np.log10((c[w] + 1) / (n + v + 1)) for w in own), 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == want
    assert all(r.score < 0 for r in out)


def small_model(v=40):
    m = lm.Attention(v)
    r = np.random.default_rng(0)
    seqs = [np.array([(s + i * 3) % (v - 1) for i in range(int(n))], np.int32) for s, n in zip(r.integers(0, v - 1, 60), r.integers(1, 70, 60), strict=True)]
    x, y, _ = m.windows(seqs)
    return m.train(x, y, steps=150, batch=64).finish(np.bincount(np.concatenate(seqs), minlength=v).astype(float)), seqs


@pytest.mark.parametrize("sent", [False, True])
def test_model_is_a_causal_distribution(sent):
    """As it is trained, and as tasks are sent it."""
    import pickle

    m, seqs = small_model()
    m = pickle.loads(pickle.dumps(m)) if sent else m
    # the next id's probabilities sum to one, whatever stands before
    for start in ([], [1], [4, 7, 10], [*range(39)]):
        p = [10 ** (m.scores([np.array([*start, i], np.int32)])[0]) for i in range(39)]
        ended = 10 ** m.scores([np.array(start, np.int32)])[0]
        # p holds the end after each id, so compare through prefixes: sum over ids and the end of p(start, id...) = p(start)
        one = [10 ** prefix(m, [*start], i) for i in range(40)]
        assert sum(one) == pytest.approx(1, abs=1e-3) and ended > 0 and min(p) > 0
    assert m.scores(seqs).sum() > -0.8 * sum(len(s) + 1 for s in seqs) * np.log10(40)


def prefix(m, start, nxt):
    """log10 p(nxt | start), by scoring the end against another sequence that shares the window."""
    x, y, _ = m.windows([np.array([*start, 0], np.int32)])
    row, col = divmod(len(start), lm.STRIDE)
    target = np.full_like(y, -1)
    target[row, col] = nxt
    keep = m.windows
    m.windows = lambda s: (x.copy(), target, np.zeros(len(x), int))
    try:
        return m.scores([None])[0]
    finally:
        m.windows = keep


def test_windows_score_each_token_once():
    m = lm.Attention(100)
    for n in (0, 1, 15, 16, 17, 40, 100):
        x, y, owner = m.windows([np.arange(n, dtype=np.int32)])
        assert y[y >= 0].tolist() == [*range(n), 99] and x.shape[1] == lm.WINDOW
    full, at = m.windows([np.arange(90, dtype=np.int32)])[0], 3
    assert full[at].tolist() == [*range(at * 16 - 17, at * 16 + 15)]


def test_scores_are_those_of_the_training_pass():
    """The table-driven scores against the forward pass that is trained, token by token and with no floor."""
    m, seqs = small_model()
    slow = lm.Attention(40)
    slow.p, slow.experts = m.p, m.experts
    for ids in [*seqs[:20], np.array([38, 0, 38, 0], np.int32), np.zeros(0, np.int32)]:
        x, y, _ = slow.windows([ids])
        f = slow.forward(x, y, slow.experts)
        assert m.scores([ids])[0] == pytest.approx(np.log10(f["joint"].sum(-1)[f["ok"]].astype(float)).sum(), rel=1e-4)


def test_scores_outside_the_bounds_are_those_of_the_training_pass():
    """Attention and gates that may overflow are bounded or checked batch by batch; others are not even looked at."""
    m, seqs = small_model()
    m.tabled()
    assert m.calm_gate or m.calm_attention  # as after training
    m.p = {k: v * (12 if k in "QKGH" else 1) for k, v in m.p.items()}
    m.tabled()
    assert not m.calm_gate and not m.calm_attention
    slow = lm.Attention(40)
    slow.p, slow.experts = m.p, m.experts
    for ids in seqs[:20]:
        x, y, _ = slow.windows([ids])
        f = slow.forward(x, y, slow.experts)
        assert m.scores([ids])[0] == pytest.approx(np.log10(f["joint"].sum(-1)[f["ok"]].astype(float)).sum(), rel=1e-3)


def test_words_of_blocks_are_those_of_bytes():
    """Lower-cased A-Z alone, cut at ASCII blanks alone, with none at the ends."""
    texts = [" a\tB\x0b\x0cc\r\n ", "", " ", "\u00c0\u00a0\u2028B\x1cc \x85", "\u0130 K\u212a", "a a A"]
    docs, *_ = lm.worked(1, pa.array(range(len(texts))), np.ones(len(texts), bool), [t.encode() for t in texts], lm.Subwords(lm.load()))
    want = [t.encode().lower().split() for t in texts]
    at = {w: i for i, w in reversed([*enumerate(dict.fromkeys(w for x in want for w in x))])}
    assert docs.column(5).to_pylist() == [len(x) for x in want]
    assert [np.frombuffer(w, np.int32).tolist() for w in docs.column(7).to_pylist()] == [[at[w] for w in x] for x in want]


def test_language_model_gradients_by_differences():
    m = lm.Attention(9, seed=2)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    r = np.random.default_rng(1)
    m.experts = r.dirichlet(np.ones(9), lm.EXPERTS).T
    x, y, _ = m.windows([r.integers(0, 8, 37).astype(np.int32), r.integers(0, 8, 5).astype(np.int32)])

    def loss():
        f = m.forward(x, y, m.experts)
        return -np.log(f["joint"].sum(-1)[f["ok"]]).mean()

    f = m.forward(x, y, m.experts)
    found = m.gradients(x, f, f["joint"] / f["joint"].sum(-1, keepdims=True))
    for k, v in m.p.items():
        for at in map(tuple, r.integers(0, v.shape, (12, v.ndim))):
            was, e = v[at], 1e-5
            v[at] = was + e
            up = loss()
            v[at] = was - e
            down = loss()
            v[at] = was
            assert found[k][at] == pytest.approx((up - down) / (2 * e), rel=1e-3, abs=1e-7), (k, at)


def test_every_window_may_be_drawn():
    """Over places, one in share of the windows of long and of short documents is drawn; all of them at a share of one."""
    m = lm.Attention(50)
    ids = [np.arange(n, dtype=np.uint16) % 49 for n in (0, 5, 40, 3_000)]
    rows = pa.RecordBatch.from_arrays([pa.array([0] * 400), pa.array([*range(400)]), pa.array([ids[i % 4].tobytes() for i in range(400)], pa.binary())], names=["block", "idx", "ids"])
    whole = sum(len(m.windows([i.astype(np.int32)])[0]) for i in ids) * 100
    n = lambda share: sum(len(x) for x, _ in lm.drawn(share, 3)(m, [rows]))
    assert n(1) == whole and abs(n(8) - whole / 8) < whole / 40


def test_averages_and_sums_of_tasks():
    a, b = lm.Attention(6, 1), lm.Attention(6, 2)
    rows = []
    for m, n in ((a, 3.0), (b, 1.0)):
        dense = np.concatenate([m.p[k].ravel() for k in sorted(m.p) if k != "E"])
        rows.append(lm.sums_of([2, 4, lm.DENSE], [n, n, n], [m.p["E"][2] * n, m.p["E"][4] * n, dense * n]))
    out = lm.Attention(6, 5)
    kept = out.p["E"][0].copy()
    (batch,) = lm.added(rows)
    from types import SimpleNamespace

    lm.average(out, [SimpleNamespace(**r) for r in batch.to_pylist()])
    assert np.allclose(out.p["E"][4], (3 * a.p["E"][4] + b.p["E"][4]) / 4, atol=1e-6) and (out.p["E"][0] == kept).all()
    assert all(np.allclose(out.p[k], (3 * a.p[k] + b.p[k]) / 4, atol=1e-6) for k in out.p if k != "E")
    import pickle

    m, seqs = small_model()
    sent = pickle.loads(pickle.dumps(m))
    assert np.allclose(sent.experts.sum(0), 1, atol=1e-5) and np.allclose(sent.scores(seqs), m.scores(seqs), rtol=2e-3)
    i, r = lm.summed(np.array([3, 1, 3]), np.array([[1.0], [2.0], [4.0]]))
    assert i.tolist() == [1, 3] and r.tolist() == [[2.0], [5.0]]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_model_beats_the_base_on_held_out_documents(spark, folder):
    out = lm.op5_lm(spark, folder).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert out[0] / out[2] > out[1] / out[2]


def test_more_of_the_corpus_goes_into_the_model(spark):
    """What the tasks send of the experts' shares follows the documents, and long ones give as much as their length."""
    sub = lm.Subwords(lm.load())
    text = " ".join(f"word{i % 97}" for i in range(4_000))
    m = lm.Attention(sub.end + 1)
    m.spread(np.ones(sub.end + 1))

    def mass(texts):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
        where = lm.parts(df, spark.sparkContext.broadcast(lm.load())).where("kind = 0").withColumn("train", F.lit(True))
        return sum(r.weight for r in lm.gathered(where, m, lm.shares))

    one, three, long = mass([text] * 8), mass([text] * 24), mass([" ".join([text] * 3)] * 8)
    assert 2.5 < three / one < 3.5 and 2.5 < long / one < 3.5


def test_language_model_on_no_rows(spark, none):
    assert lm.score(none).count() == 0


# --- 6 near-duplicates ----------------------------------------------------------------------------------------------


def test_signatures_estimate_weighted_similarity():
    r = np.random.default_rng(1)
    for _ in range(6):
        e = r.integers(0, 2**63, 300, dtype=np.uint64)
        a, b = r.integers(0, 9, 300), r.integers(0, 9, 300)
        want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        x, y = (minhash.signature(e[w > 0], w[w > 0], 4000) for w in (a, b))
        assert (x == y).mean() == pytest.approx(want, abs=0.04)
        assert np.isfinite(x).all()


def test_signature_of_few_and_heavy_elements():
    one = minhash.signature(np.array([5], np.uint64), np.array([1]))
    assert np.isfinite(one).all()
    a, b = (minhash.signature(np.array([5], np.uint64), np.array([w]), 3000) for w in (1000, 500))
    assert (a == b).mean() == pytest.approx(0.5, abs=0.05)


def brute_classes(rows, least=0.8):
    bags = []
    for _, t in rows:
        w = words(t)
        bags.append(Counter(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else Counter())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            total = sum((bags[i] | bags[j]).values())
            if not total or sum((bags[i] & bags[j]).values()) / total >= least:
                up[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(rows))]


def test_classes_by_brute_force(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    root = brute_classes(rows)
    first = {}
    for (d, _), k in zip(rows, root, strict=True):
        first[k] = min(first.get(k, d), d)
    want = {d: first[k] for (d, _), k in zip(rows, root, strict=True)}
    got = {r.doc_id: r.class_id for r in minhash.with_ids(minhash.classes(docs)).collect()}
    assert got == want and len(set(want.values())) < len(want)


def test_chains_are_one_class(spark):
    w = [f"t{i}" for i in range(400)]
    rows = [(i, " ".join([f"new{j}" for j in range(i * 8)] + w[i * 8 :])) for i in range(12)]
    got = {r.class_id for r in minhash.with_ids(minhash.classes(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert got == {0}


def test_twins_among_strangers_of_a_template(spark, monkeypatch):
    """Strangers of similarity 0.77 crowd the buckets; each twin (0.84) is found among them, in one block or several."""
    shared = [f"t{i}" for i in range(104)]
    rows = []
    for pair in range(70):
        for half in (0, 1):
            rows.append((2 * pair + half, " ".join([*shared, *[f"p{pair}x{i}" for i in range(5)], *[f"p{pair}h{half}x{i}" for i in range(10)]])))
    want = {d: d - d % 2 for d, _ in rows}
    assert [rows[k][0] for k in brute_classes(rows)] == [want[d] for d, _ in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for most, elements in ((512, 400_000), (8, 400_000), (512, 900)):
        monkeypatch.setattr(minhash, "BLOCK_MEMBERS", most)
        monkeypatch.setattr(minhash, "BLOCK_ELEMENTS", elements)
        assert {r.doc_id: r.class_id for r in minhash.with_ids(minhash.classes(df)).collect()} == want


def test_forest_of_a_block_by_brute_force(monkeypatch):
    """The links join what the overlaps join, with columns in several matrices, repeated runs and known classes."""
    monkeypatch.setattr(minhash, "BLOCK_COLUMNS", 7)
    r = np.random.default_rng(4)
    for cross in (False, True):
        texts = [" ".join(r.choice(["a", "b", "c"], int(r.integers(1, 30)))).encode() for _ in range(40)]
        bags = [minhash.bag(t) for t in texts]
        assert all(minhash.overlap(a, b) == pytest.approx(minhash.alike(minhash.bagged(pa.array([s])), minhash.bagged(pa.array([t])))[0].as_py()) for a, s in zip(bags, texts) for b, t in zip(bags[:9], texts))
        second, known = np.arange(40) % 2, r.integers(0, 30, 40)
        links = minhash.forest(np.arange(40), known, second, cross, [minhash.expanded(*b) for b in bags], 0.5)

        def roots(edges):
            up = [*range(40)]
            find = lambda i: i if up[i] == i else find(up[i])
            for i, j in edges:
                up[find(i)] = find(j)
            return [find(i) for i in range(40)]

        same = [(i, j) for i in range(40) for j in range(i) if known[i] == known[j]]
        real = [(i, j) for i in range(40) for j in range(i) if minhash.overlap(bags[i], bags[j]) >= 0.5 and (not cross or second[i] != second[j])]
        assert {*map(tuple, map(sorted, links))} <= {*map(tuple, map(sorted, real))} and len(links) < 40
        a, b = roots(links + same), roots(real + same)
        assert all((a[i] == a[j]) == (b[i] == b[j]) for i in range(40) for j in range(i))


def test_near_duplicates_of_awkward_rows(spark, awkward, none):
    found = minhash.with_ids(minhash.classes(awkward)).collect()
    assert len(found) == len(AWKWARD) and minhash.classes(none).count() == 0
    by = {}
    for r in found:
        by.setdefault(r.class_id, []).append(r.doc_id)
    assert sorted(by[6]) == [6, 7, 8] and by[4] == [4, 4] and len(by[1]) == 4
    kept = minhash.dedup(awkward)
    assert kept.columns == awkward.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 4, 5, 6, None, 9, 100, 200, 12])


# --- 9 decontamination, 10 licenses ---------------------------------------------------------------------------------


def test_windows_by_brute_force(spark):
    r = np.random.default_rng(3)
    v = list("abcé")
    make = lambda n: "  ".join(r.choice(v, n)).upper()
    docs = [(i, make(int(r.integers(0, 60)))) for i in range(80)] + [(80, None), (80, None)]
    items = [(i, make(int(n))) for i, n in enumerate([0, 1, 2, 9, 10, 11, 12, 15])] + [(90, None), (91, make(3)), (None, "a b")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    for most, distinct in ((1 << 20, decontaminate.MOST_WORDS), (40, decontaminate.MOST_WORDS), (1 << 20, 3)):
        got = Counter(tuple(x) for x in decontaminate.told(decontaminate.scan(d, b, most, distinct)).collect())
        want = Counter()
        for i, t in docs:
            w, hit, ids = words(t), set(), set()
            for k, s in items:
                own = words(s)
                n = min(len(own), 10)
                for a in range(len(own) - n + 1 if own else 0):
                    for p in range(len(w) - n + 1):
                        if w[p : p + n] == own[a : a + n]:
                            hit |= {*range(p, p + n)}
                            ids.add(k)
            said = ",".join(sorted(str(k) for k in ids if k is not None))
            want[i, len(w), len(hit), len(ids), hashlib.sha256(said.encode()).hexdigest(), bool(hit)] += 1
        assert got == want


def test_spans_are_offsets_of_the_text(spark):
    text = "é: Some Words, and then " + "one two THREE four five six seven eight nine ten" + " end"
    hit = decontaminate.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([(5, "One, two three four five six seven eight nine ten!")], "item_id long, text string")).first()
    (a, b), = hit["_ll_hit"].spans
    assert text[a:b] == "one two THREE four five six seven eight nine ten"


def test_decontamination_of_awkward_rows(spark, awkward, none):
    items = spark.createDataFrame([(1, PASSAGE), (2, "one")], "item_id long, text string")
    kept = decontaminate.clean(awkward, items)
    assert kept.columns == awkward.columns and kept.count() == len(AWKWARD) - 4
    assert decontaminate.clean(awkward, items.limit(0)).count() == len(AWKWARD)
    assert decontaminate.told(decontaminate.scan(none, items)).count() == 0
    with pytest.raises(ValueError, match="_ll_hit"):
        decontaminate.clean(awkward.withColumn("_ll_hit", F.lit(1)), items)


def test_more_distinct_words_than_one_automaton_holds():
    """An item of 50 distinct words, at most 24 of them in an automaton: every window of it is whole in some piece."""
    text = " ".join(f"w{i}" for i in range(50))
    cut = [words(t) for _, t in decontaminate.pieces(7, text, 12)]
    assert all(len(c) <= 12 for c in cut)
    assert {tuple(c[i : i + 10]) for c in cut for i in range(len(c) - 9)} == {tuple(words(text)[i : i + 10]) for i in range(41)}
    assert [*decontaminate.pieces(None, "a b", 12)] == [(None, "a b")]


def test_phrases_by_brute_force(spark, docs, awkward):
    both = docs.union(awkward.select("doc_id", "text")).union(spark.createDataFrame([(900, "mit LICENSE mit license cc by cc by-nc GNU general public license GNU general, public"), (901, "apache\n license")], "doc_id long, text string"))
    got = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.scan(both).collect())
    want = Counter()
    for r in both.collect():
        w, at = words(r.text), []
        for phrase, label in licenses.PHRASES:
            own = phrase.split(" ")
            at += [(p, label) for p in range(len(w)) if w[p : p + len(own)] == own]
        places = [p for p, _ in at]
        want[r.doc_id, len(w), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at}))] += 1
    assert got == want


def test_notices_with_gaps(spark):
    mit = licenses.NOTICES[0][0].split(" ")
    changed = [*mit[:8], "really", *mit[8:]]
    rows = [(1, "x y " + " ".join(mit).upper()), (2, "x " + ", ".join(changed)), (3, " ".join(mit[:7]))]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].labels == "mit" and got[1].score == 1.0 and got[1].spans[0].first_word == 2
    assert got[2].labels == "mit" and 0.6 < got[2].score < 1 and got[3].labels == "" and 0 < got[3].score < 0.6
    assert got[1].n_base == 0 and got[1].base_labels == ""


def test_licenses_of_no_rows(none):
    assert licenses.scan(none).count() == 0


@pytest.mark.parametrize("name", ["op1_simhash", "op10_licenses"])
def test_native_plans(spark, sf, name):
    plan = registry.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_rows_of_a_block():
    """Distinct words once, with hashes that tell them and counts of training rows; documents as places among them."""
    texts = [b"a a a a a a a b", b"a a A", b"c"]
    batches = [b.to_pylist() for b in lm.worked(5, pa.array([1, 2, 3]), np.array([True, False, True]), texts, lm.Subwords(lm.load()))]
    found = [r for batch in batches for r in batch]
    words_ = [r for r in found if r["kind"] == lm.WORD]
    assert [(r["idx"], r["train_n"]) for r in words_] == [(0, 7), (1, 1), (2, 1)] and len({(r["h1"], r["h2"]) for r in words_}) == 3
    assert [np.frombuffer(r["words"], np.int32).tolist() for r in found if r["kind"] == lm.DOC] == [[0] * 7 + [1], [0] * 3, [2]]


def test_a_block_goes_on_over_steps_and_batches(spark):
    """Three texts of more than STEP_BYTES in one task share one list of words, until a fourth one fills the block."""
    texts = [" ".join(["lorem", "Lorem", f"own{i}"] * 500_000) for i in range(3)] + ["x " * 5_000_000, "lorem"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    rows = lm.parts(df, spark.sparkContext.broadcast(lm.load())).select("kind", "block", "idx", "train_n", "n_words", F.octet_length("words").alias("b")).collect()
    docs, words_ = ([r for r in rows if r.kind == k] for k in (lm.DOC, lm.WORD))
    assert [(r.block, r.idx, r.n_words, r.b) for r in docs] == [(0, 0, 1_500_000, 6_000_000), (0, 1, 1_500_000, 6_000_000), (0, 2, 1_500_000, 6_000_000), (0, 3, 5_000_000, 20_000_000), (1, 0, 1, 4)]
    n = [crc(i) % 7 != 2 for i in range(5)]
    assert [(r.block, r.idx, r.train_n) for r in words_] == [(0, 0, 1_000_000 * sum(n[:3])), *((0, 1 + i, 500_000 * n[i]) for i in range(3)), (0, 4, 5_000_000 * n[3]), (1, 0, int(n[4]))]


def test_shuffles_of_a_table_go_once_it_is_written(spark):
    files = lambda: spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    held = lambda: set(re.findall(r"shuffle_[0-9_]+\.data", files().mkString("|")))
    before = held()
    with lm.shuffles_go(spark):
        table = common.cut(spark.range(100_000).groupBy((F.col("id") % 9_973).alias("k")).count())
    end = time.time() + 10
    while held() - before and time.time() < end:
        time.sleep(0.1)
    assert not held() - before and table.count() == 9_973


def test_texts_of_millions_of_characters_without_a_blank(spark, tmp_path):
    """One word of two million letters, twice, and one of as many marks: every operator works on it whole."""
    letters = "".join(np.random.default_rng(0).choice(list("abcdefgh"), 2_000_000))
    rows = [(1, letters), (2, letters), (3, "!" * 2_000_000), (4, "a short text"), (5, letters[:-1] + "\n")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0), (3, 0, 1), (4, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, letters), (2, "short text")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {name: {r.doc_id: r for r in f(spark, str(tmp_path)).collect()} for name, f in registry.queries().items() if name != "pipeline" and name != "op5_lm"}
    assert all(len(r) == 5 for r in got.values())
    assert got["op6_minhash"][2].class_id == 1 and got["op9_decontaminate"][1].n_hit == got["op9_decontaminate"][4].n_hit - 1 == 1
    assert got["op1_simhash"][3].n_chars == 2_000_000 and got["op1_simhash"][1].fingerprint == got["op1_simhash"][2].fingerprint
    assert len({got["op2_bpe"][i].ids_sha256 for i in (1, 2)}) == 1 and got["op2_bpe"][3].n_tokens > 0
    sub = lm.Subwords(lm.load())
    ids, n = sub.ids([letters.encode()])
    assert len(ids) == n[0] and np.isfinite(lm.Attention(sub.end + 1).finish(np.ones(sub.end + 1)).scores([ids.astype(np.int32)]))


def test_what_a_worker_keeps_is_bounded():
    kept = common.Kept(len, 10)
    assert kept["x" * 100] == 100 and not kept
    for i in range(50):
        assert kept[f"k{i}"] == len(f"k{i}")
    assert len(kept) <= 10 and len(kept.old) <= 10


@pytest.mark.parametrize("run, column", [(lambda d: bpe.encode(d), "_ll_bpe"), (lambda d: units.dedup_runs(d), "_ll_copy"), (lambda d: minhash.dedup(d), "_ll_r"), (lambda d: mil.keep_good(d, d.select("doc_id", F.lit(1).alias("quality"))), "_ll_score")])
def test_own_columns_are_refused(awkward, run, column):
    with pytest.raises(ValueError, match=column):
        run(awkward.withColumn(column, F.lit(1)))
