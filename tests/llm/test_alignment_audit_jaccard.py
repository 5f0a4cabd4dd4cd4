"""The alignment, the filter audit and the Jaccard join against brute force, and on awkward rows."""

import hashlib
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from conftest import same
from test_operators import AWKWARD

from shardloom.llm import alignment, audit, jaccard, minhash, registry


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame([(i, t, "l", 1.0, 2, "u") for i, t in AWKWARD], "doc_id long, text string, source string, n_a double, node int, mask string")


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")


# --- 11 alignment ---------------------------------------------------------------------------------------------------


def brute_align(texts):
    """Digest columns of each text by the libraries' own encoders and plain loops."""
    import json

    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    names = {i: t for t, i in json.load(open(P.path("byte_bpe_50k.json")))["model"]["vocab"].items()}
    of = alignment.byte_alphabet()
    piece = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    found = []
    for text in texts:
        x, y = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        bx, by = [bytes(of[c] for c in names[i]) for i in x], [piece(i) for i in y]
        if not text or not b"".join(bx) == b"".join(by) == (" " + text).encode():
            found.append(None)
            continue
        groups, i, j, ends = [], 0, 0, [0, 0]
        own_a, own_b = [], []
        while i < len(x) or j < len(y):
            if ends[0] <= ends[1] and i < len(x):
                own_a.append(x[i])
                ends[0] += len(bx[i])
                i += 1
            else:
                own_b.append(y[j])
                ends[1] += len(by[j])
                j += 1
            if ends[0] == ends[1]:
                groups.append((own_a, own_b))
                own_a, own_b = [], []
        links = Counter((p, q) for g in groups for p in g[0] for q in g[1])
        found.append((len(x), len(y), groups, links))
    count = Counter(pair for f in found if f for pair in f[3])
    most, most_b = Counter(), Counter()
    for (p, q), n in count.items():
        most[p], most_b[q] = max(most[p], n), max(most_b[q], n)
    out = []
    for f in found:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, "", 0))
            continue
        said = ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in f[2])
        links = f[3].items()
        best = sum(n for pair, n in links if count[pair] == most[pair[0]])
        best_b = sum(n for pair, n in links if count[pair] == most_b[pair[1]])
        out.append((f[0], f[1], len(f[2]), f[3].total(), best, sum(n * count[pair] for pair, n in links), hashlib.sha256(said.encode()).hexdigest(), best_b))
    return out


TOLD = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_best_b"]


def aligned(df):
    return Counter((r.doc_id, *(r[c] for c in TOLD)) for r in alignment.align(df).collect())


ODD = [(300, "a▁b"), (301, "  two  blanks\t\n\r tab "), (302, "<0x41> <s> </s> <unk> <|endoftext|>"), (303, "\x00\x01\x7f"), (304, "ab" * 3000), (305, "!?" * 2500), (306, " " * 3000 + "x"), (307, "é" * 4000), (None, "the same text"), (None, "the same text"), (2**62 + 1, "a large id")]


@pytest.mark.parametrize("most", [1_000_000, 60])
def test_alignment_by_brute_force(spark, docs, awkward, monkeypatch, most):
    """Also where blocks hold a document or two."""
    monkeypatch.setattr(alignment, "BLOCK_LINKS", most)
    more = spark.createDataFrame(ODD, "doc_id long, text string")
    rows = docs.union(awkward.select("doc_id", "text")).union(more).repartition(3)
    held = [(r.doc_id, r.text) for r in rows.collect()]
    assert aligned(rows) == Counter((d, *x) for (d, _), x in zip(held, brute_align([t for _, t in held]), strict=True))


def test_large_groups_are_laid_out_by_distinct_ids(monkeypatch):
    """Links of a group by distinct ids and counts are those of its tokens."""
    import public_tokenizers as P

    aligner = alignment.Aligner(*(open(P.path(f), "rb").read() for f in (alignment.A_FILE, alignment.B_FILE)))
    r = np.random.default_rng(1)
    n_a, n_b = np.array([3, 40, 1, 200]), np.array([2, 50, 1, 90])
    ids_a, ids_b, doc = r.integers(0, 30, n_a.sum()), r.integers(0, 30, n_b.sum()), np.array([0, 0, 1, 1])
    want = Counter()
    at_a, at_b = 0, 0
    for g in range(4):
        for x in ids_a[at_a : at_a + n_a[g]]:
            for y in ids_b[at_b : at_b + n_b[g]]:
                want[int(doc[g]), int(x) * aligner.width + int(y)] += 1
        at_a, at_b = at_a + n_a[g], at_b + n_b[g]
    for most in (4096, 100, 10**9):
        monkeypatch.setattr(alignment, "LARGE_GROUP", most)
        got = Counter()
        for d, p, n in aligner.links(ids_a, ids_b, n_a, n_b, doc):
            for x in zip(d.tolist(), p.tolist(), n.tolist(), strict=True):
                got[x[:2]] += x[2]
        assert got == want


def test_fast_and_slow_ids_are_equal(docs):
    import public_tokenizers as P

    a = alignment.ByteTokenizer(open(P.path(alignment.A_FILE), "rb").read())
    assert a.fast is not None
    texts = [" " + r.text for r in docs.collect() if r.text] + [" " + t for _, t in ODD]
    fast = a.encode(texts)
    a.fast = None
    assert a.encode(texts) == fast


def test_alignment_of_no_rows_and_long_texts(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(none).count() == 0 and alignment.dictionary(none).count() == 0
    letters = "".join(np.random.default_rng(0).choice(list("abcdefgh"), 1_000_000))
    df = spark.createDataFrame([(1, letters), (2, "!" * 1_000_000), (3, "short")], "doc_id long, text string").repartition(3)
    rows = {r.doc_id: r for r in alignment.align(df).collect()}
    assert rows[1].n_a > 0 and rows[1].n_groups > 0 and rows[1].n_links >= max(rows[1].n_a, rows[1].n_b) and len(rows) == 3


def test_dictionary_counts_documents(spark):
    df = spark.createDataFrame([("the the dog",), ("the dog",), ("a dog",)], "text string")
    pairs = alignment.dictionary(df).collect()
    assert max(r["count"] for r in pairs) == 3 and all(r.best or r["count"] < 3 for r in pairs)
    assert len({(r.a_id, r.b_id) for r in pairs}) == len(pairs)


def aligner():
    import public_tokenizers as P

    return alignment.Aligner(*(open(P.path(f), "rb").read() for f in (alignment.A_FILE, alignment.B_FILE)))


def same_rows(a, b):
    assert len(a) == len(b)
    for c in a.columns:
        assert all(np.array_equal(x, y) for x, y in zip(a[c], b[c], strict=True)), c


def test_words_are_aligned_once(monkeypatch):
    """The encoders get each distinct word once, not each text."""
    of, said = aligner(), []
    encode = of.b.encode
    monkeypatch.setattr(of.b, "encode", lambda texts: said.extend(texts) or encode(texts))
    texts = ["some words, which come again and again"] * 500 + ["words which come"] * 500
    of.aligned(texts)
    of.aligned(texts)
    assert sum(map(len, said)) < 100


def test_words_give_what_whole_texts_give(monkeypatch):
    monkeypatch.setattr(alignment, "MOST_WORDS", 20)  # words are let go between chunks
    by_word, whole = aligner(), aligner()
    assert by_word.by_word
    whole.by_word = False
    odd = ["a  b", " a", "a ", "a\u2581b c", "x" * 400 + " y", "line\nline two\n\nthree", "it's 's 't a's", "\u00a0a b", "a\x1cb \x1c c", "", None, " ", "<s> </s> <0x0A>", "\u0301a \u0301", "\U0001f600 \U0001f600 e\u0301", "12 345 6789 1,000.5", "tail \n word", "a\x00b c"]
    texts = [t for _, t in AWKWARD if len(t or "") < 100_000]
    for some in (odd, texts, odd + ["plain words alone"] * 3 + texts, ["plain words"], [""]):
        same_rows(by_word.aligned(some), whole.aligned(some))


# --- 12 filter audit ------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_audit_is_the_sqls(spark, folder):
    same(audit.op12_filter_audit(spark, folder), audit.ORACLE, folder)


def brute_audit(rows, labels):
    """Each order applied to each part, document by document."""
    fails = []
    for doc_id, text, _ in rows:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        own = {"A": len(w) < 50, "B": 100 * len({*w}) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search(r"[#$%&*|]", text))}
        own["E"] = doc_id is not None and any(d is not None and d < doc_id and (t or "") == text for d, t, _ in rows)
        fails.append({k for k, v in own.items() if v})
    out = {}
    parts = {s or "" for _, _, s in rows}
    for part in parts:
        inside = [(f, labels.get(d, (0, 0)) if d is not None else (0, 0)) for f, (d, _, s) in zip(fails, rows, strict=True) if (s or "") == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = inside
            for k, letter in enumerate(order):
                gone = [x for x in left if letter in x[0]]
                out[part, "".join(order), k + 1] = [len(left) - len(gone), len(gone), sum(letter in x[0] for x in inside) - len(gone), sum(x[0] == {letter} for x in inside), sum(x[1][0] == 1 for x in gone), sum(x[1][1] == 1 for x in gone)]
                shapley[letter] += len(gone)
                left = [x for x in left if letter not in x[0]]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


def test_audit_by_brute_force(spark, monkeypatch):
    r = np.random.default_rng(5)
    long = " ".join(f"word{i}" for i in range(60))
    kinds = [None, "", " ", "A short One", long, long + " # mark", "same " * 70, "UPPER " * 80, long.upper(), "日本 " * 60, long + "\x0bvertical\x1cnot"]
    rows = [(None if r.random() < 0.1 else int(r.integers(0, 80)), kinds[int(r.integers(0, len(kinds)))], [None, "", "x", "y z"][int(r.integers(0, 4))]) for _ in range(300)]
    said = {i: (int(r.integers(0, 2)), int(r.integers(0, 2))) for i in range(0, 80, 3)}
    labels = spark.createDataFrame([(i, *v) for i, v in said.items()] + [(3, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    want = brute_audit(rows, said)
    df = spark.createDataFrame([(*x, 1, 2) for x in rows], "doc_id long, text string, source string, mask int, part int").repartition(4)
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    for most in (2_000, 2):
        monkeypatch.setattr(audit, "MOST_PARTS", most)
        assert {(x.part, x.filter_order, x.step): [x[n] for n in names] for x in audit.audit(df, labels).collect()} == want


def test_audit_of_no_rows_and_awkward_ones(spark, awkward):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(none, labels).count() == 0
    assert audit.audit(awkward, labels).count() == 600


# --- 13 Jaccard join ------------------------------------------------------------------------------------------------


def sets_of(texts):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append({tuple(w[i : i + 4]) for i in range(max(len(w) - 3, 1))} if w else set())
    return out


def brute_join(rows):
    sets = sets_of([t for _, t in rows])
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                up[max(root(i), root(j))] = min(root(i), root(j))
    first = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            first[root(i)] = min(first.get(root(i), d), d)
    return Counter((d, len(sets[i]), first.get(root(i))) for i, (d, _) in enumerate(rows))


def join_rows(df, **k):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.joined(df, **k).collect())


def test_join_by_brute_force(docs, awkward):
    rows = docs.union(awkward.select("doc_id", "text"))
    want = brute_join([(r.doc_id, r.text) for r in rows.collect()])
    assert join_rows(rows) == want


def test_join_on_a_larger_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    assert join_rows(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == brute_join(rows)


@pytest.mark.parametrize("rounds", [1, 3])
def test_links_at_the_very_threshold(spark, monkeypatch, rounds):
    """Sets that differ in as many runs as they may, and in one more; families whose members link through others; all
    lengths from one word, whichever order the counts give."""
    monkeypatch.setattr(minhash, "BLOCK_MEMBERS", 4)
    r = np.random.default_rng(rounds)
    rows = []
    for n in [*range(1, 14), 17, 20, 23, 40, 43, 83, 100, 163]:
        base = [f"n{n}w{i}" for i in range(n)]
        for cut in (0, 1, 2, n // 20, n // 14, n // 12, n // 11):
            rows.append(" ".join(base[: n - cut] + [f"n{n}c{cut}x{i}" for i in range(cut)]))
            rows.append(" ".join([f"n{n}d{cut}x{i}" for i in range(cut)] + base[cut:]))
            rows.append(" ".join(base[: n - cut]))
    template = [f"t{i}" for i in range(120)]
    for k in range(40):
        text = template.copy()
        for at in r.choice(120, 3, replace=False):
            text[at] = f"edit{k}y{at}"
        rows.append(" ".join(text))
    rows = [*enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert join_rows(df, rounds=rounds) == brute_join(rows)


def test_prefixes_hold_the_matches_of_any_link(monkeypatch):
    """For any counts and any choices of l, two linked sets share as many prefix runs as promising() asks."""
    r = np.random.default_rng(2)
    for _ in range(300):
        n = int(r.integers(1, 60))
        a = r.choice(1000, n, replace=False)
        b = np.unique(np.concatenate([a[: max(1, n - int(r.integers(0, 8)))], r.choice(1000, int(r.integers(0, 6)))]))
        both = len(np.intersect1d(a, b))
        if 100 * both < 85 * (len(a) + len(b) - both):
            continue
        rank = r.integers(0, 5, 1000)
        sides = []
        for x in (a, b):
            t = jaccard.least_shared(len(x))
            m = int(r.integers(1, t + 1))
            sides.append((t, m, x[np.lexsort((x, rank[x]))][: len(x) - t + m]))
        (ta, la, pa_), (tb, lb, pb) = sides
        assert len(np.intersect1d(pa_, pb)) >= max(ta, tb) - max(ta - la, tb - lb)
        assert len(np.intersect1d(pa_[: len(pa_) - la + 1], pb[: len(pb) - lb + 1]))


def test_prefixes_grow_with_candidates():
    found = [jaccard.matches(200, postings) for postings in (0, 1, 30, 3000)]
    assert found[0] == 1 and found == sorted(found) and 1 < found[-1] <= jaccard.least_shared(200)
    assert all(jaccard.matches(n, 50) <= jaccard.least_shared(n) for n in range(1, 300))


def test_sizes_that_may_link_share_a_band(spark):
    wide = np.log(100 / jaccard.PERCENT) * (1 + 1e-9)
    n = np.arange(1, 200_000)
    band = np.floor(np.log(n) / wide)
    most = n * 100 // jaccard.PERCENT  # the largest size that n may link with
    assert (np.floor(np.log(most) / wide) - band <= 1).all()


def test_join_of_no_rows_and_native_filters(spark, awkward):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.joined(none).count() == 0
    found = jaccard.joined(awkward.select("doc_id", "text")).collect()
    empty = [r for r in found if r.n_shingles == 0]
    assert all(r.component_id == r.doc_id and r.component_size == 1 for r in empty) and {r.doc_id for r in empty} == {1, 2, 3, None}


def test_registered(spark, sf):
    for name, rows in (("op11_alignment", 200), ("op13_jaccard", 200)):
        assert registry.queries()[name](spark, sf).count() == rows
    assert "op12_filter_audit" in registry.oracle_sql()


def test_words_hash_alike_wherever_they_stand(monkeypatch):
    """The same words give the same hashes in short and long texts, alone or among others, in segments of any size."""
    import pyarrow as pa

    r = np.random.default_rng(7)
    letters = "".join(r.choice(list("abcdefgh"), jaccard.LONG_WORD + 10))
    vocabulary = [f"w{i}é" for i in range(3000)] + [letters, letters[:-1] + "X", letters[: jaccard.LONG_WORD]]
    texts = [" ".join(r.choice(vocabulary[:3000], int(r.integers(0, 40)))) for _ in range(50)]
    texts += ["", None, "\t\x0b \n", " ".join(r.choice(vocabulary[:3000], 200_000)), " ".join([*vocabulary[3000:], "a", "b", "C", *vocabulary])]
    want = {}
    for t, got in zip(texts, jaccard.shingle_sets(pa.array(texts, pa.string())), strict=True):
        assert np.array_equal(got, jaccard.shingles(None if t is None else t.encode()))
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        runs = {tuple(w[i : i + 4]) for i in range(max(len(w) - 3, 1))} if w else set()
        assert len(got) == len(runs)
        for run in [*runs][:300]:
            (own,) = jaccard.shingles(" ".join(run).encode())
            assert own in got and want.setdefault(run, own) == own
