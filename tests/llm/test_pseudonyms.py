"""Feistel pseudonyms against an independent computation and their own inverse."""

from __future__ import annotations

import hashlib

import pytest

from opinara.llm.pseudonyms import ROUNDS, pseudonymise

VALUES = {
    "card": "4539578763621486",
    "card_spaced": "4539 5787 6362 1486",
    "iban": "DE89370400440532013000",
    "phone": "+1 (017) 555-7713",
    "ssn": "536-22-8710",
    "ipv4": "97.51.17.173",
    "iso": "2021-02-28",
    "dmy": "31.12.1999",
}


def run(spark, rows, inverse=False, key="k"):
    df = spark.createDataFrame(rows, "doc_id long, text string, n_pseudonyms string, old string, l long")
    return {r.doc_id: r for r in pseudonymise(df, key, inverse=inverse).collect()}


def permuted(left, right, a, b, tag):
    for i in range(1, ROUNDS + 1):
        noise = lambda half: int(hashlib.sha256(f"{tag}|{i}|{half}".encode()).hexdigest()[:15], 16)  # noqa: B023, E731
        if i % 2:
            left = (left + noise(right)) % a
        else:
            right = (right + noise(left)) % b
    return left, right


def luhn(s):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(s))) % 10 == 0


def test_formats_linking_and_inverse(spark):
    rows = [(k, f"a {v}, b {v}!! c", "x", "y", 1) for k, v in enumerate(VALUES.values())]
    got = run(spark, rows)
    for k, (kind, value) in enumerate(VALUES.items()):
        new = got[k].text[2:].split(", b ")[0]
        assert got[k].text == f"a {new}, b {new}!! c" and new != value and got[k].n_pseudonyms == 2, kind
        assert [c.isdigit() for c in new if kind != "ipv4"] == [c.isdigit() for c in value if kind != "ipv4"], kind
        if kind.startswith("card"):
            assert luhn(new.replace(" ", "")) and new[0] == value[0]
        if kind == "iban":
            assert int("".join(str(int(c, 36)) for c in new[4:] + new[:4])) % 97 == 1
    assert got[0].text[2:18] == got[1].text[2:21].replace(" ", "")
    back = run(spark, [(k, r.text, None, None, None) for k, r in got.items()], inverse=True)
    assert {k: r.text for k, r in back.items()} == {r[0]: r[1] for r in rows}
    assert run(spark, rows, key="other")[0].text != got[0].text


WIDER = [
    "DE89 3704 0044 0532 0130 00", "FR1420041010050500013M02606", "FR14 2004 1010 0505 0001 3M02 606",
    "MT84MALT011000012345MTLCAST001S", "MU17BOMM0101101030300200000MUR",
    "12/31/2024", "3/4/2024", "12/3/2024", "5-28-1999", "2024.3.14", "555.123.4567", "555 123 4567",
]


def test_wider_forms_change_within_their_form_and_back(spark):
    rows = [(k, f"see {v} THEN", None, None, None) for k, v in enumerate(WIDER)]
    got = run(spark, rows)
    kind = lambda s: ["d" if c.isdigit() else "a" if c.isalpha() else c for c in s]
    for k, value in enumerate(WIDER):
        new = got[k].text[4:-5]
        assert got[k].text == f"see {new} THEN" and new != value and kind(new) == kind(value) and got[k].n_pseudonyms == 1, value
        if value[0].isalpha():
            plain = new.replace(" ", "")
            assert int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1 and new[:2] == value[:2]
        if value in ("12/31/2024", "5-28-1999"):
            assert int(new[:2].rstrip("-")) <= 12 < int(new[-7:-5])
    back = run(spark, [(k, r.text, None, None, None) for k, r in got.items()], inverse=True)
    assert {k: r.text for k, r in back.items()} == {r[0]: r[1] for r in rows}


def test_against_plain_python(spark):
    got = run(spark, [(1, "10.20.30.40", None, None, None), (2, "+1 (017) 555-7713", None, None, None)])
    l, r = permuted(10 * 256 + 20, 30 * 256 + 40, 65536, 65536, "k|ipv4")  # noqa: E741
    assert got[1].text == f"{l // 256}.{l % 256}.{r // 256}.{r % 256}"
    l, r = permuted(1755, 57713, 10**5, 10**5, "k|phone")  # noqa: E741
    d = f"{l:05}{r:05}"
    assert got[2].text == f"+1 ({d[:3]}) {d[3:6]}-{d[6:]}"


@pytest.mark.parametrize(
    "text",
    [None, "", "no digits", "4539578763621487", "999.1.1.1", "version 2.0.", "2021-02-30", "000-12-3456", "1234", "x" * 300_000],
)
def test_unvalidated_text_stays(spark, text):
    row = run(spark, [(1, text, None, None, None)])[1]
    assert row.text == text and row.n_pseudonyms == 0


def test_permutation_of_a_small_format(spark):
    days = [f"{y}-{m:02}-{d:02}" for y in (1800, 2000, 2199) for m in (1, 12) for d in (1, 2, 30, 31)]
    got = run(spark, [(k, d, None, None, None) for k, d in enumerate(days)])
    assert len({r.text for r in got.values()}) == len(days)


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "1.2.3.4"), (1, "1.2.3.4"), (None, "1.2.3.4")], "doc_id long, text string")
    rows = pseudonymise(df, "k").collect()
    assert len(rows) == 3 and len({r.text for r in rows}) == 1
    assert pseudonymise(df.limit(0), "k").count() == 0
