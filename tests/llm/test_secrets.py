import re
from collections import Counter

from comarca.llm import secret_scan

ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def brute(text):
    text = text or ""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


def test_base_spans(docs, odd_docs):
    for df in (docs, odd_docs):
        for r in df.collect():
            assert secret_scan.base_spans(r.text or "") == brute(r.text)


def test_failing_matches_use_up_their_text():
    for text in ("password: token: abcdefgh", "PASSWORD:abcdef", "paſſword: abcdefgh", "AKIAAKIA" + "B" * 16, "f" * 23 + "g" + "0" * 24):
        assert secret_scan.base_spans(text) == brute(text)


def test_costs():
    cost = secret_scan.guess_cost
    assert cost("password") < 1 and cost("aaaaaaaaaaaa") < 4 and cost("qwertyuiop") < 4
    assert cost("20240131") < 5 and cost("P@ssw0rd2024") < 9
    assert cost("xK9$vQ2!mZ7w") > 15 and cost("") == 0


def test_guessed_spans():
    text = "The passphrase is xK9$vQ2!mZ7w. Your password is password1 and token is monkey2024"
    spans = secret_scan.guessed_spans(text, secret_scan.base_spans(text), 9.0)
    assert [text[s:e] for _, s, e in spans] == ["xK9$vQ2!mZ7w"]


def test_redaction(odd_docs):
    assert secret_scan.redacted("a token=abcdefgh b", [("assign", 2, 16), ("hex", 8, 16)]) == "a [assign] b"
    for r in secret_scan.scan(odd_docs, redact=True).collect():
        assert not secret_scan.base_spans(r.text)


def test_rows(odd_docs):
    got = secret_scan.scan(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert secret_scan.scan(odd_docs.where("false")).count() == 0


def test_clash(odd_docs):
    from pyspark.sql import functions as F

    got = secret_scan.scan(odd_docs.withColumns({"spans": F.lit(1), "n_hex": F.lit("x")}))
    assert dict(got.dtypes)["spans"] == "string" and got.count() == odd_docs.count()


def spans_of(text):
    base = secret_scan.base_spans(text)
    return base, [text[s:e] for _, s, e in secret_scan.guessed_spans(text, base, 9.0)]


def test_symbol_after_the_sixth_character(spark):
    text = "my password: Summer@2024#xyz for you"
    assert spans_of(text) == ([("assign", 3, 19)], ["Summer@2024#xyz"])
    assert spans_of("password: abcdefgh12.")[1] == []
    row = secret_scan.scan(spark.createDataFrame([(text,)], "text string"), redact=True).first()
    assert row.text == "my [assign] for you" and row.n_assign == 1


def test_values_of_one_class():
    for context, value in (("passphrase is ", "correcthorsebatterystaple"), ("pwd: ", "8391750264917"), ("bearer ", "qmzkvxwpltrbnsdj"), ("private key: ", "QWXZKVJPMRTL")):
        assert spans_of(context + value)[1] == [value]


def test_plain_and_hyphenated_words_stay(spark):
    texts = [
        "your password is case-sensitive", "the secret is Persistence", "The token is authentication", "Password: required-field", "the passphrase is everything.",
        "the secret is Collaboration!", "credentials: documentation", "a token is up-to-date", "the secret is consistency.", "token is well-known",
    ]
    for text in texts:
        assert spans_of(text)[1] == []
    kept = [t for t in texts if not secret_scan.base_spans(t)]
    got = secret_scan.scan(spark.createDataFrame([(t,) for t in kept], "text string"), redact=True).collect()
    assert Counter(r.text for r in got) == Counter(kept)
    assert len(secret_scan.word_ranks()) < 40_000


def test_cheapest_cut_is_that_of_all_cuts():
    """The dynamic programme against every segmentation of short values."""
    import math

    ranks = secret_scan.word_ranks()

    def brute_cost(value):
        spans = secret_scan._Spans(value, ranks)
        every = [list(spans.at(i)) for i in range(len(value))]

        def cuts(i):
            return 0.0 if i == len(value) else min(cost + cuts(j) for j, cost in every[i])

        return cuts(0)

    for value in ("pass1234", "abcabcabc", "x9$Qm2", "2024-01-31", "P@ssw0rd1", "aaaaabbb", "summer-day", "1qaz2wsx", "zzzz", "a"):
        assert math.isclose(secret_scan.guess_cost(value), brute_cost(value))


def test_span_prices():
    prices = {j: c for j, c in secret_scan._Spans("password", {"password": 1, "pass": 2}).at(0)}
    assert prices[8] < prices[4] < 1 and prices[1] > 1
    assert min(c for j, c in secret_scan._Spans("20240131x", {"zz": 1}).at(0) if j == 8) < 5


def test_very_long_values_end():
    import time

    began = time.perf_counter()
    for value in ("k" * 200_000, "xK9$vQ2!mZ7w" * 80_000, "ab" * 100_000, "token " * 100_000):
        text = "passphrase: " + value
        spans = secret_scan.guessed_spans(text, secret_scan.base_spans(text), 9.0)
        assert bool(spans) == ("$" in value)
    assert time.perf_counter() - began < 90


def test_bound_agrees_with_the_whole_cost():
    for value in ("q7" * 20 + "correct horse", "xK9$vQ2!mZ7w" * 20, "a" * 400):
        assert (secret_scan.guess_cost(value, enough=9.0) >= 9.0) == (secret_scan.guess_cost(value) >= 9.0)
