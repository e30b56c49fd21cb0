"""Each operator against a plain version of its contract on small tables."""

import hashlib
import re
import struct
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

pytest.importorskip("loomwork.llm")
from loomwork.llm import decontaminate, exact, langid, packing, pii, quality, simhash, toxicity  # noqa: E402
from loomwork.llm.components import components  # noqa: E402
from loomwork.llm.fmindex import FMIndex  # noqa: E402


def docs_at(spark, path):
    return spark.read.parquet(f"{path}/documents.parquet")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


# --- personal data -------------------------------------------------------

PII_PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain_pii(text):
    out = []
    for kind, pattern in PII_PLAIN.items():
        for m in pattern.finditer(text):
            digits = [int(c) for c in m.group() if c.isascii() and c.isdigit()]
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                total = sum(d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(reversed(digits)))
                if not 16 <= len(digits) <= 19 or total % 10:
                    continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


@pytest.mark.parametrize(
    "text",
    [
        "a@b.c", "@@a@b.c.d@e.f", "x@y", "é.a-b@c-d.e_f", "a@b.c@d.e.f", "..@a.b", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.1", "0000255.1.1.1", "11.2.3",
        "4111 1111 1111 1111", "4111-1111-1111-1111 2", "4111  1111 1111 1111", "+1 (017) 555-7713 x", "+1((((", "+12", "+1 23", "+1 234 5678 )", "+44+44 1234 567890",
        "call +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7", "1" * 300, "a" * 300 + "@", "1.1.1.1.", "9" * 19, "+9999999999999999",
    ],
)
def test_pii_base_spans(text):
    assert [x[:3] for x in pii.find(text) if x[0] in pii.BASE_KINDS] == plain_pii(text)


def test_pii_random_strings():
    rng = np.random.default_rng(3)
    for _ in range(3000):
        text = "".join(rng.choice(list("01259.@+- ()ab%É"), rng.integers(0, 60)))
        assert [x[:3] for x in pii.find(text) if x[0] in pii.BASE_KINDS] == plain_pii(text), text


def test_pii_checksums_and_context():
    iban = "DE89370400440532013000"
    assert pii.mod97(iban) and not pii.mod97(iban[:-1] + "1")
    assert [x[0] for x in pii.find(f"konto {iban} bitte")] == ["iban"]
    assert pii.find("DE89370400440532013001 konto") == []
    amex = "378282246310005"
    assert pii.find(f"number {amex} there") == []
    assert [x[0] for x in pii.find(f"amex card {amex}")] == ["card_short"]


def test_pii_table(odd, none):
    rows = pii.find_pii(odd).collect()
    assert len(rows) == odd.count()
    for r, (_, text) in zip(sorted(rows, key=lambda r: r.doc_id or -1), sorted(pairs(odd), key=lambda r: r[0] or -1), strict=True):
        said = ",".join(f"{k}:{s}:{e}" for k, s, e in plain_pii(text or ""))
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert pii.find_pii(none).count() == 0


# --- exact duplicates ----------------------------------------------------


def plain_exact(rows):
    groups, norm = defaultdict(list), {}
    for i, t in rows:
        norm[i, t] = hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest()
        groups[norm[i, t]].append(i)
    out = []
    for i, t in rows:
        g = groups[norm[i, t]]
        keep = min((x for x in g if x is not None), default=None)
        out.append((i, keep, len(g), i == keep, norm[i, t]))
    return Counter(out)


@pytest.mark.parametrize("bits", [exact.BITS, 256])
def test_exact_groups(odd, spark, small, bits):
    for docs in (odd, docs_at(spark, small)):
        got = exact.exact_groups(docs, bits=bits).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
        assert Counter(map(tuple, got.collect())) == plain_exact(pairs(docs))


def test_exact_is_native(odd):
    plan = exact.exact_groups(odd)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_drop_copies(odd, none):
    kept = exact.drop_copies(odd)
    assert kept.columns == odd.columns
    want = {k[4]: k[1] for k in plain_exact(pairs(odd))}
    assert Counter(r.doc_id for r in kept.collect()) == Counter(want.values())
    assert exact.drop_copies(none).count() == exact.exact_groups(none).count() == 0


# --- SimHash -------------------------------------------------------------


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    sh = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fp_by_row):
    ids = list(fp_by_row)
    up = {i: i for i in ids}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            if (fp_by_row[i] ^ fp_by_row[j]).bit_count() <= 2:
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def test_simhash(odd, spark, small):
    for docs in (odd.where("doc_id is not null").dropDuplicates(["doc_id"]), docs_at(spark, small)):
        want = {i: plain_fingerprint(t) for i, t in pairs(docs)}
        comp = plain_components(want)
        got = by_id(simhash.near_duplicates(docs))
        assert {i: r.fingerprint for i, r in got.items()} == {i: f"{f:016x}" for i, f in want.items()}
        assert {i: r.component_id for i, r in got.items()} == comp
    assert simhash.near_duplicates(odd).count() == odd.count()


def test_anchors_cover():
    """Any two fingerprints within two bits: each is at the home anchor of the other."""
    rng = np.random.default_rng(1)
    x = rng.integers(-(1 << 63), (1 << 63) - 1, 400, dtype=np.int64)
    y = x.copy()
    for k in range(len(y)):
        for b in rng.choice(64, rng.integers(0, 3), replace=False):
            y[k] ^= np.int64(np.uint64(1 << int(b)).astype(np.int64))
    home, _, _ = simhash.anchors(x)
    _, row, anchor = simhash.anchors(y)
    got = set(zip(row.tolist(), anchor.tolist(), strict=True))
    assert all((k, h) in got for k, h in enumerate(home.tolist()))


def test_components_chain(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 90), (90, 95)]
    edges = spark.createDataFrame([p for a, b in links for p in ((a, b), (b, a))], "a long, b long")
    got = {r.node: r.label for r in components(edges).collect()}
    assert got == {**{k: 0 for k in range(41)}, 90: 90, 95: 90, 100: 90}


def test_drop_near_duplicates(odd, none):
    kept = simhash.drop_near_duplicates(odd)
    ids = {r.doc_id for r in simhash.near_duplicates(odd).where("doc_id = component_id").collect()}
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == ids
    assert simhash.drop_near_duplicates(none).count() == 0


# --- decontamination -----------------------------------------------------


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_hits(text, items):
    words, hit, found = plain_words(text), set(), set()
    for item_id, item in items:
        seq = plain_words(item)
        for a in range(max(1, len(seq) - 12) if seq else 0):
            win = seq[a : a + 13]
            for p in range(len(words) - len(win) + 1):
                if words[p : p + len(win)] == win:
                    hit.update(range(p, p + len(win)))
                    found.add(str(item_id))
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 800])
def test_contamination(spark, odd, small, block):
    long = " ".join(f"w{k % 17}" for k in range(60))
    items = [(1, "A, b"), (2, long), (3, ""), (4, None), (10, "the quick brown fox"), (11, long[:90]), (12, "a b")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    extra = spark.createDataFrame([(900, f"x {long} y A b"), (901, "a-B" * 5), (902, long[3:150] + " | the Quick. brown; fox")], "doc_id long, text string")
    docs = odd.select("doc_id", "text").where("length(text) < 5000 or text is null").unionByName(extra)
    real = docs_at(spark, small).where("length(text) < 3000").limit(60).select("doc_id", "text")
    for d, b in ((docs, bench), (real, spark.read.parquet(f"{small}/benchmark.parquet"))):
        known = [(r.item_id, r.text) for r in b.collect() if r.text is not None]
        got = decontaminate.find_contamination(d, b, block_bytes=block)
        want = Counter((i, *plain_hits(t, known)) for i, t in pairs(d))
        assert Counter(map(tuple, got.collect())) == want
        clean = Counter(r.doc_id for r in decontaminate.drop_contaminated(d, b, block_bytes=block).collect())
        assert clean == Counter(k[0] for k in want.elements() if not k[5])


def test_contamination_empty(odd, none, spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert {(r.n_hit, r.contaminated) for r in decontaminate.find_contamination(odd, bench).collect()} == {(0, False)}
    assert decontaminate.find_contamination(none, bench).count() == 0
    assert decontaminate.drop_contaminated(odd, bench).count() == odd.count()


def test_fm_index():
    rng = np.random.default_rng(2)
    for top, n in ((3, 200), (40, 500), (2, 50)):
        t = rng.integers(0, top + 1, n)
        index = FMIndex(t, top)
        for size in (1, 2, 4):
            pats = rng.integers(1, top + 1, (30, size))
            lo, hi = index.search(pats)
            for p, a, b in zip(pats, lo, hi, strict=True):
                want = [k for k in range(n - size + 1) if (t[k : k + size] == p).all()]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == want


# --- packing -------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_vocabulary())
    tok.encode_special_tokens = True
    return tok


def test_encoder(tokenizer, odd):
    encoder = packing.Encoder(packing.default_vocabulary())
    more = ["a\nb c", " a", "a ", "a  b", "it's 'x' don't", "a \n b", "é b", "<|endoftext|> x", "x y z", "tab\tz", "a\n\nb", "\nq", "... !! ?", "1 22 333"]
    for text in [t or "" for _, t in pairs(odd)] + more:
        assert encoder.encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def test_packing(odd, none, tokenizer, spark, small):
    for docs in (odd, docs_at(spark, small)):
        rows = packing.pack(docs).collect()
        want = Counter()
        for i, t in pairs(docs):
            ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
            first = len(ids) if len(ids) <= 2048 else len(ids) % 2048 or 2048
            cuts = [0, *range(first, len(ids), 2048), len(ids)]
            for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                want[i, k, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))] += 1
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
        bins = defaultdict(list)
        for r in rows:
            bins[r.sequence_id].append((r.offset, r.length))
        for got in bins.values():
            at = 0
            for offset, n in sorted(got):
                assert offset == at
                at += n
            assert at <= 2048
        assert len(bins) <= -(-sum(r.length for r in rows) // 2048) * 1.02 + 2
    assert packing.pack(none).count() == 0


def test_packing_is_best_on_small_cases():
    """Against the exact optimum by search, and every piece placed once."""
    rng = np.random.default_rng(4)

    def optimum(sizes, cap):
        best = [len(sizes)]

        def go(k, bins):
            if len(bins) >= best[0]:
                return
            if k == len(sizes):
                best[0] = len(bins)
                return
            for j in {b: n for n, b in enumerate(bins)}.values():
                if bins[j] + sizes[k] <= cap:
                    bins[j] += sizes[k]
                    go(k + 1, bins)
                    bins[j] -= sizes[k]
            go(k + 1, [*bins, sizes[k]])

        go(0, [])
        return best[0]

    for _ in range(60):
        sizes = sorted(rng.integers(1, 21, rng.integers(1, 9)).tolist(), reverse=True)
        count = dict(Counter(sizes))
        reduced = dict(count)
        fixed = packing.reduce_sizes(reduced, 20)
        n_fixed = sum(n for _, n in fixed)
        rest = [s for s, n in reduced.items() for _ in range(n)]
        assert n_fixed + optimum(sorted(rest, reverse=True), 20) == optimum(sizes, 20), sizes
        used = Counter()
        for p, n in fixed + packing.best_fit(reduced, 20):
            assert sum(p) <= 20
            used.update({s: c * n for s, c in Counter(p).items()})
        assert used == Counter(sizes)


# --- classifiers ---------------------------------------------------------


def test_quality_held_out(spark, odd, none):
    path = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{path}/labels.parquet")
    got = quality.held_out_scores(docs_at(spark, path), labels)
    right = got.join(labels, "doc_id").where("held_out").agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0]
    assert right > 0.95
    few = spark.createDataFrame([(1, 0), (4, 1), (25, None), (None, 1), (31, 0)], "doc_id long, quality int")
    for d in (odd, none):
        rows = quality.held_out_scores(d, few).collect()
        assert len(rows) == d.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert {r.score for r in quality.held_out_scores(odd, few.where("false")).collect()} == {0.5}


def test_quality_ignores_held_out_labels(spark, small):
    labels = spark.read.parquet(f"{small}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (by_id(quality.held_out_scores(docs_at(spark, small), x)) for x in (labels, turned))
    assert {i: r.score for i, r in a.items()} == {i: r.score for i, r in b.items()}


def test_vote_is_exact():
    rng = np.random.default_rng(9)
    ref = rng.standard_normal((300, 8)).astype(np.float32)
    ref /= np.linalg.norm(ref, axis=1, keepdims=True)
    model = {"latent": ref, "label": (rng.random(300) < 0.5).astype(np.float32)}
    z = rng.standard_normal((50, 8)).astype(np.float32)
    for row, s in zip(z, quality.vote(z, model), strict=True):
        sims = ref @ (row / np.linalg.norm(row))
        near = np.argsort(-sims)[: quality.NEIGHBOURS]
        w = np.maximum(sims[near].astype(float), 1e-6)
        assert s == pytest.approx((w * model["label"][near]).sum() / w.sum(), abs=1e-4)


def test_language_held_out(spark, odd, none):
    docs = docs_at(spark, "/root/testdata/sf0.01")
    got = langid.held_out_languages(docs).join(docs.select("doc_id", "lang"), "doc_id")
    assert got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.97
    rows = langid.held_out_languages(odd).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    letters = {i: any(unicodedata.category(x)[0] == "L" for x in t or "") for i, t in pairs(odd)}
    assert all((r.lang_pred == "und") == (not letters[r.doc_id]) for r in rows)
    assert langid.held_out_languages(none).count() == 0
    assert {r.lang_pred for r in langid.held_out_languages(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_language_of_numerals(spark):
    """Numerals of any kind (No, Nl, Nd) and marks are no letters."""
    texts = ["²", "½ ①", "Ⅷ ↂ", "٣ 7", "\u0301", "_", "²a", "ª", "漢", "ǅ"]
    assert {unicodedata.category(x) for t in texts for x in t} >= {"No", "Nl", "Nd", "Mn", "Ll", "Lo", "Lt"}
    rows = [(k, "some english words", "en") for k in range(40)] + [(100 + k, t, "fr") for k, t in enumerate(texts)]
    got = {r.doc_id: r.lang_pred for r in langid.held_out_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert [got[100 + k] == "und" for k in range(len(texts))] == [True] * 6 + [False] * 4


def test_toxicity(spark, odd, none):
    path = "/root/testdata/sf0.1"
    docs, labels = docs_at(spark, path), spark.read.parquet(f"{path}/labels.parquet")
    learn = labels.where("crc32(cast(doc_id as string)) % 3 <> 1")
    got = toxicity.score_toxicity(docs, learn).withColumnRenamed("toxic", "p").join(labels, "doc_id").where("crc32(cast(doc_id as string)) % 3 = 1")
    r = got.agg(F.sum(F.expr("p * toxic")).alias("hit"), F.sum("p").alias("said"), F.sum("toxic").alias("all")).first()
    assert r.hit / r["all"] > 0.9 and r.hit / r.said > 0.95
    few = spark.createDataFrame([(1, 0), (4, 1), (25, None), (None, 1), (31, 0)], "doc_id long, toxic int")
    for d in (odd, none):
        rows = toxicity.score_toxicity(d, few).collect()
        assert len(rows) == d.count() and all(0 <= r.p_toxic <= 1 for r in rows)
        assert toxicity.drop_toxic(d, few).columns == d.columns
    assert toxicity.drop_toxic(odd, few.where("false")).count() == odd.count()


def test_chain_uses_out_of_fold():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((200, 3)).astype(np.float32)
    y = np.stack([x[:, 0] > 0, x[:, 0] > 0.5], 1).astype(np.float32)
    chain, _ = toxicity.fit_chain(x, y, np.arange(200) % toxicity.FOLDS)
    assert [len(w) for w in chain] == [4, 5]
