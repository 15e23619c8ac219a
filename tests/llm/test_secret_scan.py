import itertools
import random
import re
import string

import numpy as np
import pytest

from logcube.llm.secret_scan import scan_secrets, scanner, stretches, train
from tests.llm.conftest import AWKWARD, SF

KEY = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
BASE = [
    ("assign", KEY + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
]


def base(text):
    found = [(m.start(), i, m.end(), kind) for i, (kind, p, g, n) in enumerate(BASE) for m in re.finditer(p, text or "") if len(m[g]) >= n]
    return [(kind, s, e) for s, _, e, kind in sorted(found)]


@pytest.fixture(scope="module")
def ratio(spark):
    return train(spark.read.parquet(f"{SF}/documents.parquet"))


def known(spans):
    return [(s["kind"], s["start"], s["end"]) for s in spans if s["kind"] != "markov"]


def test_base_spans_of_all_documents(spark, ratio):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: known(r.spans) for r in scan_secrets(docs, ratio).collect()}
    assert got == {r.doc_id: base(r.text) for r in docs.collect()}
    assert any(got.values())


def test_awkward_forms_of_the_base(ratio):
    texts = [
        'API_KEY: "abcdef" apikey=abcde token=token:abcdefgh', "é\U0001f600 Password = 'x.y=z/w' AKIA" + "A1" * 8 + " AKIASHORT AKIAAKIA" + "Z" * 14,
        "f" * 23 + " " + "f" * 24 + "g" + "0" * 30, "toKen=abcdefgh paſſword=abcdefgh", 'secret"  :  "----------', "token==abcdef", "tokens = abcdefg",
        "password" * 3 + "=secretsecret", "AKIA" * 6, "",
    ]
    for text in texts:
        assert known(scanner(ratio)(text)) == base(text), text


LOWER, MIXED = string.ascii_lowercase, string.ascii_letters + string.digits
FORMS = {"mixed": MIXED, "lower and digits": LOWER + string.digits, "lower": LOWER, "url-safe": MIXED + "_-", "hex": "0123456789abcdef"}
#: Least share of random keys found whole, by alphabet and length.
FOUND = [("mixed", 16, 0.75), ("mixed", 19, 0.9), ("mixed", 24, 0.97), ("mixed", 32, 0.97), ("lower and digits", 24, 0.9), ("lower", 32, 0.95), ("url-safe", 24, 0.88), ("hex", 20, 0.8)]


@pytest.mark.parametrize("form,length,share", FOUND)
def test_share_of_random_keys_found(ratio, form, length, share):
    rng, hits = random.Random(3), 0
    for before, after in (("x ", " y"), ("see /usr/share/lib/", "\n"), ("(", ")")):
        for _ in range(200):
            key = "".join(rng.choices(FORMS[form], k=length))
            spans = scanner(ratio)(before + key + after)
            hits += any(s["start"] <= len(before) and s["end"] >= len(before) + length for s in spans)
    assert hits >= share * 600


def test_ordinary_words_and_identifiers_are_left_alone(ratio):
    words = ["theanonthereandofthationwhereas", "Getting-started-with-the-documentation", "getElementByIdOrNullFromTheList2", "2024-01-02-some-title-of-a-post", "4785380592391139478538", "Internationalization_of_settings"]
    words += ["https://example.com/path/to/some-page_2021.html", "MAX_RETRY_COUNT_EXCEEDED", "x86_64-unknown-linux-gnu", "org.apache.spark.sql.catalyst", "978-3-16-148410-0", "=" * 90, "-" * 90, "x" * 5000, "_" * 70]
    assert [w for w in words if scanner(ratio)(f"a {w} b")] == []


def test_known_forms_are_cut_out_of_a_run(ratio):
    rng = random.Random(5)
    for _ in range(50):
        key, other = "".join(rng.choices(MIXED, k=40)), "".join(rng.choices(MIXED, k=40))
        text = f"token={key} {other}%token={key}/"
        spans = [(s["kind"], text[s["start"] : s["end"]]) for s in scanner(ratio)(text)]
        assert [x for k, x in spans if k == "assign"] == [f"token={key}", f"token={key}/"]
        assert [x for k, x in spans if k == "markov"] == [other]


def test_stretches_are_the_greatest_sums():
    rng = np.random.default_rng(0)
    for _ in range(300):
        steps = np.round(rng.normal(-0.3, 2, rng.integers(1, 30)))
        got = stretches(steps, 4.0)
        best = max((steps[i:j].sum(), -i, j) for i in range(len(steps)) for j in range(i + 1, len(steps) + 1))
        assert (max((v for _, _, v in got), default=None) or 0) == (best[0] if best[0] >= 4 else 0)
        assert all(steps[a : b + 1].sum() == v >= 4 for a, b, v in got)
        assert all(b < c for (_, b, _), (c, _, _) in itertools.pairwise(sorted(got)))
        left = np.ones(len(steps), bool)
        for a, b, _ in got:
            left[a : b + 1] = False
        for part in np.split(steps, np.flatnonzero(np.diff(left.astype(int))) + 1):  # nothing is left between them
            if len(part) and not any(np.array_equal(part, steps[a : b + 1]) for a, b, _ in got):
                assert max((part[i:j].sum() for i in range(len(part)) for j in range(i + 1, len(part) + 1)), default=0) < 4


def test_clean_documents_have_no_added_spans(spark, ratio):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert sum(s["kind"] == "markov" for r in scan_secrets(docs, ratio).collect() for s in r.spans) == 0


def test_awkward_rows(awkward, empty, ratio):
    rows = scan_secrets(awkward, ratio).collect()
    assert sorted((str(r.doc_id), known(r.spans)) for r in rows) == sorted((str(d), base(t)) for d, t, *_ in AWKWARD)
    assert scan_secrets(empty, train(empty)).count() == 0
