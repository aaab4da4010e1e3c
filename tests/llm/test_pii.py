import random

from helpers import awkward_docs, clashing, frame
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import pii


def check(rows, got):
    want = sorted(((r[0], *pii.brute_base(r[1])) for r in rows), key=repr)
    assert sorted(((r.doc_id, [r.n_email, r.n_ip, r.n_card, r.n_phone], r.base_sha256) for r in got), key=repr) == want


def test_awkward_rows_match_plain_patterns(spark):
    rows = awkward_docs()
    rng = random.Random(2)
    bits = ["a.b@x.org", "@", "a@b", "x@y.z@w.v", "1.2.3.4", "256.1.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+49 (30) 123-456", "+1", " ", "..", "é", "0", "+", "-", "9" * 30]
    rows += [(500 + k, "".join(rng.choice(bits) for _ in range(12)), "en", "z", 0) for k in range(300)]
    rows.append((900, "1" * 50_000 + " " + "a" * 50_000 + " " + "a@b " * 5_000, "en", "z", 0))
    docs = clashing(frame(spark, rows), "pii", "spans", "kind")
    check(rows, pii.digest(pii.detect_pii(docs.select("doc_id", "text"))).collect())


def test_empty_table(spark):
    assert pii.digest(pii.detect_pii(frame(spark, []).select("doc_id", "text"))).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a.@-+ 0123459()%é\n", max_size=60))
def test_spans_equal_plain_patterns(text):
    counts, sha = pii.brute_base(text)
    base = pii.base_spans(text)
    import hashlib

    joined = ",".join(f"{k}:{a}:{b}" for k in pii.BASE for a, b in base[k])
    assert ([len(base[k]) for k in pii.BASE], hashlib.sha256(joined.encode()).hexdigest()) == (counts, sha)


def test_added_kinds_need_checksum_or_context():
    good, bad = "DE89 3704 0044 0532 0130 00", "DE89 3704 0044 0532 0130 01"
    find = lambda t: pii.added_spans(t, pii.base_spans(t), 0.55)
    assert find(f"IBAN {good}")["iban"] and not find(f"IBAN {bad}")["iban"]
    assert find("my ssn is 123-45-6789")["ssn"] == [(10, 21)]
    assert not find("build 123-45-6789")["ssn"]
    assert find("call (030) 1234 567 now")["phone_local"] and not find("in (030) 1234 567 cases")["phone_local"]
    assert pii.context_score("visa card 4111 1111 1111 1111", "card", 10, 29) == 1.0
    assert pii.context_score("test 4111 1111 1111 1111", "card", 5, 24) == 0.6


def test_validators():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("GB82WEST12345698765432") and not pii.mod97("GB82WEST12345698765433")
