from __future__ import annotations

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import pii


def luhn(s):
    digits = [int(c) for c in s[::-1]]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def digits(s):
    return re.sub("[^0-9]", "", s)


BRUTE = [
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
    (r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
    (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
]


def brute(text):
    return [(k, m.start(), m.end()) for k, (p, ok) in enumerate(BRUTE) for m in re.finditer(p, text or "") if ok(m.group())]


CASES = [
    "a.b@c.d@e.f", "@x.y z@@q.r", "a@b.c@d.e.f-", "1.2.3.4.5", "999.1.1.1 255.255.255.255 0256.1.1.1 0001.2.3.4", "4929348385146305 4929-3483 8514 6305",
    "+1 (377) 555-0271, +12 3", "+1+12345678", "1 2 3", "é@é.é ü@a.bc", "x" * 3000, "9" * 3000, "." * 50 + "@" + "." * 50,
]


@pytest.mark.parametrize("text", CASES)
def test_fixed_forms(text):
    assert pii.seeds(text) == brute(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="0159. -+()@aé_%", max_size=60))
def test_fixed_forms_of_any_text(text):
    assert pii.seeds(text) == brute(text)


def test_query(make, odd_rows):
    rows = [*odd_rows, *((20 + i, c) for i, c in enumerate(CASES))]
    found = pii.personal_data_query(make(rows)).collect()
    expected = []
    for i, text in rows:
        spans = brute(text)
        joined = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in spans)
        expected.append((i, *(sum(k == n for k, _, _ in spans) for n in range(4)), hashlib.sha256(joined.encode()).hexdigest()))
    assert sorted((tuple(r)[:6] for r in found), key=str) == sorted(expected, key=str)


def test_contexts_lead_to_unseen_identifiers(make):
    """Accounts after the words that stand before emails are found; the same after other words are not."""
    rows = [(i, f"please write to person{i}@mail.example.com today") for i in range(8)]
    rows += [(100, "please write to user-4711-x today"), (101, "room 4711b99 is open"), (102, "write it 12345678")]
    found = {r.doc_id: r for r in pii.personal_data_query(make(rows)).collect()}
    assert found[100].spans == "email:16:27" and found[100].n_found == 1 and found[100].n_email == 0
    assert found[101].spans == found[102].spans == ""
    assert all(found[i].n_email == 1 and found[i].n_found == 0 for i in range(8))


def test_empty(make):
    assert pii.personal_data_query(make([])).collect() == []
