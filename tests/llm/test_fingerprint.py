import hashlib
import math
import random
from collections import Counter

from pyspark.sql import functions as F

from logcube.llm import fingerprint as fp
from logcube.llm.queries import op4_fingerprints
from tests.llm.conftest import AWKWARD, SF


def edits(rows):
    """{(doc_id, text): edited text}, next documents in order of (doc_id, hash is left out: ids are unique here)."""
    out = {}
    for i, (d, t) in enumerate(rows):
        cut, following = len(t) // 4, rows[(i + 1) % len(rows)][1]
        out[d, t] = t[: len(t) - cut] + following[:cut]
    return out


def test_edited_texts_and_likeness_of_all_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r.doc_id, r.text or "") for r in docs.collect())
    want = edits(rows)
    got = {r.doc_id: r for r in op4_fingerprints(spark, SF).collect()}
    assert len(got) == len(rows)
    by_text = {}
    for d, t in rows:
        r = got[d]
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256(want[d, t].encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert by_text.setdefault(t, r.fingerprint) == r.fingerprint
    assert len(set(by_text.values())) == len(by_text)
    long = [r for r in got.values() if r.n_chars > 1000]
    assert sum(r.near_edited for r in long) / len(long) > 0.6 > 0.2 > sum(r.near_next for r in long) / len(long)


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_order_does_not_matter_and_parts_add_up(spark):
    a, b, ab, ba = (fp.fingerprint(F.lit(t)) for t in ("One. Two.", "Three.\nTwo.", "One. Two.\nThree.\nTwo.", "Two.\nThree. Two.\nOne."))
    r = one(spark, (fp.add(a, b) == ab).alias("sum"), (ab == ba).alias("order"), (fp.subtract(ab, b) == a).alias("less"), fp.likeness(ab, ba).alias("same"))
    assert tuple(r) == (True, True, True, 1.0)
    r = one(spark, (fp.subtract(a, a) == fp.fingerprint(F.lit(""))).alias("zero"), fp.likeness(a, fp.fingerprint(F.lit(None).cast("string"))).alias("none"))
    assert tuple(r) == (True, 0.0)


def test_lanes_are_sums_of_odd_numbers_modulo_a_power(spark):
    many = "\n".join(["p."] * 3000)
    r = one(spark, fp.fingerprint(F.lit("p.")).alias("one"), fp.fingerprint(F.lit(many)).alias("many"))
    lanes = lambda words: [w >> s & (fp.MODULUS - 1) for w in words for s in fp.SHIFTS]
    signed = [x - fp.MODULUS if x >= fp.MODULUS // 2 else x for x in lanes(r.one)]
    assert all(x % 2 and -255 <= x <= 255 for x in signed) and len(set(signed)) > 50
    assert lanes(r.many) == [3000 * x % fp.MODULUS for x in signed]


def test_awkward_rows(awkward, empty):
    got = fp.fingerprints_with_edits(awkward).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(d) for d, *_ in AWKWARD)
    texts = {d: t or "" for d, t, *_ in AWKWARD}
    following = {None: 1, 1: 2, 2: 3, 3: 4, 4: 5, 5: 6, 6: 7, 7: 8, 8: None}  # the repeated row has one next document
    for r in got:
        t, n = texts[r.doc_id], texts[following[r.doc_id]]
        cut = len(t) // 4
        assert r.edited_text == t[: len(t) - cut] + n[:cut] and r.n_chars == len(t)
    assert fp.fingerprints_with_edits(empty).count() == 0


def test_a_lone_document_is_its_own_next(spark):
    r = fp.fingerprints_with_edits(spark.createDataFrame([(1, "abcdefgh")], "doc_id bigint, text string")).first()
    assert r.edited_text == "abcdefab"


def one_line_texts():
    rng = random.Random(4)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 9))) for _ in range(4000)]
    return {
        "words": " ".join(rng.choices(words, k=900)),
        "few words": " ".join(rng.choices(words, k=40)),
        "chinese": "".join(rng.choice("，。") if i % 12 == 11 else chr(0x4E00 + int(rng.paretovariate(0.4)) % 3000) for i in range(2000)),
        "thai": "".join(chr(rng.randint(0x0E01, 0x0E2E)) for _ in range(1500)),
        "base64": "".join(rng.choices("ABCDEFGHabcdefgh01234567+/", k=3000)),
        "dna": "".join(rng.choices("ACGT", k=3000)),
        "one character": "x" * 5000,
        "spaces": "a" + " " * 5000 + "b",
    }


def test_texts_of_one_line_keep_the_likeness_of_three_quarters(spark):
    texts = one_line_texts()
    rows = [(k, t, t[: len(t) * 3 // 4] + "".join(reversed(t[len(t) * 3 // 4 :])), "Öl und q" + t) for k, t in texts.items()]
    docs = spark.createDataFrame(rows, "kind string, text string, edited string, inserted string")
    prints = {c: fp.fingerprint(F.col(c)) for c in ("text", "edited", "inserted")}
    got = docs.select("kind", "text", fp.parts(F.col("text")).alias("parts"), *[p.alias(f"fp_{c}") for c, p in prints.items()])
    got = got.select("kind", "text", "parts", *[fp.likeness(F.col("fp_text"), F.col(f"fp_{c}")).alias(c) for c in ("edited", "inserted")])
    for r in got.collect():
        assert "".join(r.parts) == r.text and len(r.parts) >= 5, r.kind
        assert r.edited > 0.5 and r.inserted > 0.5, (r.kind, r.edited, r.inserted)


def test_parts_depend_on_their_paragraph_alone(spark):
    a, b = one_line_texts()["words"], one_line_texts()["chinese"]
    pieces = [fp.parts(F.lit(t)) for t in (a, b, f"{a}\n{b}", "Short. Two.", "", "\n")]
    both = one(spark, *[p.alias(f"p{i}") for i, p in enumerate(pieces)])
    assert both.p2 == both.p0 + both.p1 and both.p3 == ["Short.", "Two."] and both.p4 == both.p5 == []


def test_lanes_do_not_wrap_in_long_texts(spark):
    docs = spark.createDataFrame([("Enau.",), ("Well then.",)], "part string")
    for n in (1, fp.RUN, fp.RUN + 1, 10_000, 100_000):
        many, less = (fp.fingerprint(F.repeat(F.concat("part", F.lit("\n")), F.lit(m))) for m in (n, n * 3 // 4))
        got = docs.select(fp.fingerprint(F.col("part")).alias("once"), many.alias("many"), less.alias("less"), fp.likeness(many, less).alias("like"))
        for r in got.collect():
            assert r.many == [n * x for x in r.once] and all(x % 2 and -255 <= x <= 255 for x in r.once)
            assert n == 1 or r.like > 0.999999, n


def cosine(a, b):
    a, b = Counter(a), Counter(b)
    norms = math.sqrt(sum(n * n for n in a.values()) * sum(n * n for n in b.values()))
    return sum(n * b[p] for p, n in a.items()) / norms if norms else 0.0


def test_likeness_is_the_cosine_of_the_multisets_of_parts(spark):
    """Brute force: the exact cosine of the parts, which the fingerprints' estimate
    with an error of about 1 / sqrt(lanes)."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    parts = {r.doc_id: r.parts for r in docs.select("doc_id", fp.parts(F.coalesce("text", F.lit(""))).alias("parts")).collect()}
    edited = fp.fingerprints_with_edits(docs).select("doc_id", fp.parts(F.col("edited_text")).alias("parts"))
    edited, ids = {r.doc_id: r.parts for r in edited.collect()}, sorted(parts)
    errors = []
    for r in op4_fingerprints(spark, SF).collect():
        following = ids[(ids.index(r.doc_id) + 1) % len(ids)]
        for got, other in ((r.near_edited, edited[r.doc_id]), (r.near_next, parts[following])):
            errors.append(got - max(0.0, cosine(parts[r.doc_id], other)))
    spread = math.sqrt(sum(e * e for e in errors) / len(errors))
    assert spread < 1 / math.sqrt(fp.WIDTH) and max(map(abs, errors)) < 5 / math.sqrt(fp.WIDTH)


def test_shared_parts_count_for_both_texts(spark, monkeypatch):
    """What the algebra gives is what hashing both whole texts gives."""
    rng = random.Random(6)
    pieces = ["\n", "\n\n", ". ", ".  ", "! ", " ", "  ", "a", "word", ". \n", "\n  ", "?", "é", "漢字", "“ ", "long words in a row that are cut by their own hashes "]
    rows = [(i, "".join(rng.choices(pieces, k=rng.randint(0, 60)))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for run in (fp.RUN, 7):
        monkeypatch.setattr(fp, "RUN", run)
        got = fp.fingerprints_with_edits(docs)
        same = [(fp.fingerprint(F.col("edited_text")) == F.col("edited_fingerprint")).alias("edited"), "doc_id", "fingerprint"]
        got = {r.doc_id: r for r in got.select(*same).collect()}
        want = {r.doc_id: r.fp for r in docs.select("doc_id", fp.fingerprint(F.col("text")).alias("fp")).collect()}
        assert len(got) == 400 and all(r.edited for r in got.values())
        assert {k: r.fingerprint for k, r in got.items()} == want
