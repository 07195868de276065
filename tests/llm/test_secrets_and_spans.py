"""Grammars of credentials, and long texts in time by their length."""

import random
import string
import time

import pytest

from loglathe.llm.automata import FormatAutomaton
from loglathe.llm.pii import personal_data
from loglathe.llm.secrets_scan import find_secrets
from loglathe.llm.spans import Taken

ALNUM = string.ascii_letters + string.digits


def of(rng, letters, n):
    return "".join(rng.choices(letters, k=n))


def hexes(rng, n):
    return of(rng, "0123456789abcdef", n)


def test_taken_stretches_equal_a_plain_list():
    rng = random.Random(1)
    for _ in range(300):
        spans = [(a, a + rng.randrange(1, 6)) for a in rng.choices(range(60), k=rng.randrange(6))]
        taken, plain = Taken(spans), list(spans)
        for _ in range(30):
            a = rng.randrange(60)
            b = a + rng.randrange(1, 6)
            assert taken.free(a, b) == all(y <= a or b <= x for x, y in plain)
            if taken.free(a, b):
                taken.add(a, b)
                plain.append((a, b))


def test_a_fixed_format_is_a_chain_that_knows_its_length():
    rng = random.Random(2)
    model = FormatAutomaton([hexes(rng, 40) for _ in range(800)])
    assert len(model.settled) == 41
    right = model.bits(hexes(rng, 40))
    assert right == pytest.approx(160, abs=3) and model.bits(hexes(rng, 39)) > right + 20 and model.bits(hexes(rng, 41)) > right + 20


def test_fixed_letters_stay_letters():
    rng = random.Random(3)
    keys = lambda: "AKIA" + of(rng, string.ascii_uppercase + "234567", 16)
    model = FormatAutomaton([keys() for _ in range(400)])
    key = model.bits(keys())
    assert key < 90 and model.bits("SHIPMENT2024ORDER77X") > key + 60 and model.bits("BKIA" + "QWERTZ2345ABCDEF") > key + 20


def test_lengths_that_vary_are_merged():
    rng = random.Random(4)
    model = FormatAutomaton(["ab" * rng.randrange(1, 60) for _ in range(1500)])
    assert len(model.settled) < 20
    model = FormatAutomaton([of(rng, ALNUM + "._-", rng.randrange(6, 60)) for _ in range(600)])
    assert len(model.settled) <= 61


FORMATS = {
    "token": lambda r: "tok_" + of(r, ALNUM, 24), "api_key": lambda r: f"{of(r, ALNUM, 8)}.{of(r, ALNUM, 16)}",
    "secret": lambda r: "-".join(of(r, string.ascii_uppercase + string.digits, 5) for _ in range(5)), "password": lambda r: hexes(r, 32),
}
DECOYS = [
    "2024-01-15T10:30:00", "192.168.100.200", "src/main/python/module.py", "https://www.example.org/path/to/page.html", "version-1.22.333-beta", "ORDER-2024-000017",
    "555-0199-4711", "4111111111111111", "0be245e3-d5f3-803b-ea20-cc27770cc0e0", "aaaa1111bbbb2222cccc", "Donaudampfschifffahrtsgesellschaft", "internationalization",
    "snake_case_identifier_name", "camelCaseIdentifierName", "CONSTANT_NAME_VALUE", "kebab-case-identifier", "user.name@example.com", "12345678901234567890",
    "0000000000000000", "ffffffffffffffffffffff", "abcabcabcabcabcabc", "2001:0db8:85a3", "3.14159265358979", "SHIPMENT2024ORDER77X", "tok_of_the_town", "tokens_and_more_tokens",
    "page-12-of-345", "ISBN-978-3-16-148410-0", "part/1/of/22", "+49-30-1234567", "100.000.000", "12345.67890", "x86_64-linux-gnu", "utf-8-encoded", "sha256sum.txt",
    "README.md.orig", "a-b-c-d-e-f-g-h", "1-2-3-4-5-6-7-8-9", "Mississippi-Missouri", "=================", "_________________", "....................",
    "AAAAA-BBBBB-CCCCC", "QUARTER-FOUR-RESULT-TABLE-TOTAL", "v1.2.3-rc.4+build.5", "en_US.UTF-8", "10/12/2024-11/12/2024", "key=value=other", "ratio=0.123456789", "base-station-alpha-7",
]


def test_unlabelled_secrets_are_found_and_ordinary_strings_are_not(table_of):
    rng = random.Random(5)
    prose = lambda: " ".join(of(rng, "etaoinshr", rng.randrange(2, 9)) for _ in range(30))
    ordinary = lambda: rng.choice([f"{rng.randrange(10**9)}", f"20{rng.randrange(10, 99)}-0{rng.randrange(1, 9)}-1{rng.randrange(9)}", f"{of(rng, 'abcde', 5)}_{of(rng, 'xyz', 4)}.py", "word-by-word", f"v{rng.randrange(9)}.{rng.randrange(99)}"])
    rows = [(i, f"{prose()} {ordinary()} {name} = \"{make(rng)}\" {prose()}") for i, (name, make) in enumerate(list(FORMATS.items()) * 250)]
    rows += [(i, f"{prose()} {ordinary()} {ordinary()} {prose()}") for i in range(1000, 2000)]
    hidden = {5000 + i: make(rng) for i, make in enumerate(list(FORMATS.values()) * 25)}
    rows += [(i, f"{prose()} see {v} for it") for i, v in hidden.items()]
    rows += [(9000 + i, f"{prose()} see {d} for it") for i, d in enumerate(DECOYS)]
    got = {r["doc_id"]: r for r in find_secrets(table_of(rows)).collect()}
    texts = dict(rows)
    found = {i: [texts[i][int(a) : int(b)] for _, a, b in (x.split(":") for x in got[i]["spans"].split(",") if x)] for i in got}
    kept = [v in found[i] for i, v in hidden.items()]
    clean = [not found[9000 + i] for i in range(len(DECOYS))]
    assert len(DECOYS) == 50 and sum(kept) / len(kept) >= 0.9, [hidden[i] for i, k in zip(hidden, kept, strict=True) if not k][:9]
    assert all(clean), [(d, got[9000 + i]["spans"]) for i, d in enumerate(DECOYS) if not clean[i]]
    assert sum(got[i]["n_added"] for i in range(1000, 2000)) <= 2


def _seconds(fn):
    t = time.time()
    fn()
    return time.time() - t


def test_two_megabytes_of_spans_take_seconds(table_of):
    rng = random.Random(6)
    contacts, tokens, size = [], [], 0
    while size < 2_000_000:
        n = rng.randrange(10**6)
        contacts.append(f"u{n}@host{n % 9}.example.com +1 (555) 555-01{n % 90:02d} 10.1.{n % 255}.4 v{n} [at] shop [dot] org 4111 1111 1111 1111 on 2024-01-1{n % 9}")
        size += len(contacts[-1])
    while size > 0:
        tokens.append(f'token = "{hexes(rng, 40)}" or {hexes(rng, 40)} and {of(rng, ALNUM, 20)} AKIA{of(rng, string.ascii_uppercase, 16)}')
        size -= len(tokens[-1])
    long_contacts, long_tokens = table_of([(1, "\n".join(contacts)), (2, "\n".join(contacts[:200]))]), table_of([(1, "\n".join(tokens)), (2, "\n".join(tokens[:200]))])
    personal_data(table_of([(2, "\n".join(contacts[:200]))])).collect()
    slow = _seconds(lambda: personal_data(long_contacts).collect()), _seconds(lambda: find_secrets(long_tokens).collect())
    assert max(slow) < 60, slow
