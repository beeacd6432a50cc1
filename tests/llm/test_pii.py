"""Personal data beside the patterns as they stand, in plain regular expressions."""

import hashlib
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from topicflow.llm import pii
from topicflow.llm.queries import queries

DATA = "/root/testdata/sf0.001"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def passes(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def plain(text):
    """The base rules word for word."""
    number = lambda m: re.sub("[^0-9]", "", m.group())
    found = [("email", m) for m in EMAIL.finditer(text)]
    found += [("ip", m) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    found += [("card", m) for m in CARD.finditer(text) if 14 <= len(number(m)) <= 19 and passes(number(m))]
    found += [("phone", m) for m in PHONE.finditer(text) if 10 <= len(number(m)) <= 15]
    return sorted(((m.start(), pii.KINDS.index(k), m.end()) for k, m in found))


def base(text):
    return [(s.start, pii.KINDS.index(s.kind), s.end) for s in pii.find_spans(text) if s.base]


PIECES = st.sampled_from(["a", "é", "@", ".", "-", " ", "+", "(", ")", "0", "1", "255", "256", "00", "9", "49927398716000", "4111 1111 1111 1111", "x.y@z.com", "@b.c", "+1 (663) 555-6869", "1.2.3.4", ".5", "%", "_", "日", "😀", "\n"])


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES, max_size=14).map("".join))
def test_base_spans_are_the_patterns(text):
    assert base(text) == plain(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a@.-+ 0129", max_size=40))
def test_base_spans_of_any_text(text):
    assert base(text) == plain(text)


@pytest.mark.parametrize("text", ["x" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 150_000, "a.b@" * 80_000, "+1 " * 100_000, "A1" * 150_000, "1 2-" * 70_000, "+" + "1" * 300_000, "0" * 200_000 + ".1.2.3"])
def test_long_runs_take_one_pass(text):
    start = time.time()
    pii.find_spans(text)
    assert time.time() - start < 5


def kinds(text):
    return [(s.kind, text[s.start : s.end]) for s in pii.find_spans(text) if not s.base]


def test_checksums():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112") and pii.luhn("79927398713")
    assert pii.mod97("GB82WEST12345698765432") and not pii.mod97("GB82WEST12345698765433")


def test_added_spans_need_a_checksum_or_their_context():
    assert kinds("Pay to DE89 3704 0044 0532 0130 00 NOW") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert kinds("Pay to GB82WEST12345698765432.") == [("iban", "GB82WEST12345698765432")]
    assert kinds("Pay to DE88 3704 0044 0532 0130 00 NOW") == []
    assert kinds("GB82WEST123456987654321") == [] and kinds("Gb82WEST12345698765432") == []
    assert kinds("Her SSN is 123-45-6789.") == [("ssn", "123-45-6789")]
    assert kinds("Part 123-45-6789 of it") == [] and kinds("SSN 000-45-6789, 666-12-1234, 123-00-1234") == []
    assert kinds("Call (020) 555-0199 now") == [("phone", "(020) 555-0199")] and kinds("In 1020 555 0199 cases") == []
    assert kinds("His visa card 4222.2222.2222.2 is") == [("card", "4222.2222.2222.2")] and kinds("Number 4222.2222.2222.2") == []
    assert kinds("at 2001:db8:85a3:0:0:8a2e:370:7334 now") == [("ip", "2001:db8:85a3:0:0:8a2e:370:7334")]
    assert kinds("release version 2001:db8:85a3:0:0:8a2e:370:7334 now") == []


def test_context_moves_scores_of_base_spans_but_keeps_them():
    score = lambda t: {s.kind: s.score for s in pii.find_spans(t)}
    assert score("host 10.0.0.1")["ip"] == 0.9 and score("see 10.0.0.1")["ip"] == 0.6 and score("version 10.0.0.1")["ip"] == 0.3


def test_documents_keep_their_rows(spark, docs, none):
    found = pii.find_pii(docs).collect()
    assert len(found) == docs.count() and pii.find_pii(none).count() == 0
    for r in found:
        assert [(s["start"], pii.KINDS.index(s["kind"]), s["end"]) for s in r["spans"] if s["base"]] == plain(r["text"] or "")
        assert r["text"] is None or r["spans"] or r["redacted"] == r["text"]


def test_redacted(spark):
    text = "Mail a.b@c.org or call +1 (663) 555-6869; card 4111 1111 1111 1111 é 1.2.3.4.5.6.7.8"
    rows = pii.find_pii(spark.createDataFrame([(1, text), (2, None), (3, "")], "spans long, text string")).collect()
    assert rows[0]["redacted"] == "Mail <EMAIL> or call <PHONE>; card <CARD> é <IP>.<IP>"
    assert (rows[1]["redacted"], rows[2]["redacted"], rows[1]["spans"]) == (None, "", [])


def test_query_equals_the_patterns(spark):
    found = {r["doc_id"]: r for r in queries()["op11_pii"](spark, DATA).collect()}
    n = 0
    for r in spark.read.parquet(f"{DATA}/documents.parquet").collect():
        want, got = plain(r["text"] or ""), found[r["doc_id"]]
        text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert got["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [got[f"n_{k}"] for k in pii.KINDS[:4]] == [sum(w[1] == i for w in want) for i in range(4)]
        assert set(filter(None, text.split(","))) <= set(got["spans"].split(","))
        n += len(want)
    assert n and len(found) == 200
