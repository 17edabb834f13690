"""Secrets and personal data against the plain patterns."""

import hashlib
import math
import random
import re

import cases
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from twinledger.llm import pii, queries, secrets

SF_DIR = "/root/testdata/sf0.001"

PLAIN_SECRETS = [
    (
        "assign",
        r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        lambda m: len(m[2]) >= 6,
    ),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
]


def digits(m):
    return re.sub("[^0-9]", "", m[0])


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


PLAIN_PERSONAL = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
]


def plain(kinds, text):
    found = sorted(
        (m.start(), k, m.end()) for k, (_, p, ok) in enumerate(kinds) for m in re.finditer(p, text or "") if ok(m)
    )
    return [(kinds[k][0], s, e) for s, k, e in found]


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


@pytest.mark.parametrize("name,kinds", [("op1_secret_scan", PLAIN_SECRETS), ("op2_personal_data", PLAIN_PERSONAL)])
def test_base_spans_of_all_documents(spark, name, kinds):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    found = queries.QUERIES[name](spark, SF_DIR).collect()
    assert len(found) == len(docs)
    for row in found:
        spans = plain(kinds, docs[row.doc_id])
        assert row.base_sha256 == digest(spans)
        assert [row[f"n_{k}"] for k, _, _ in kinds] == [sum(s[0] == k for s in spans) for k, _, _ in kinds]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1.@-+ %_é\n()5", max_size=60))
def test_personal_patterns_without_backtracking(text):
    assert [(pii.BASE_KINDS[k], s, e) for s, k, e, _ in pii.entities(text)] == plain(PLAIN_PERSONAL, text)


def test_queries_of_patterns_are_necessary():
    """Every match holds the trigrams that its query asks for."""
    examples = {
        "assign": "API_KEY = 'x9x9x9x9'",
        "access": "AKIA" + "Z" * 16,
        "hex": "0123456789abcdef01234567",
        "private_key": "-----BEGIN RSA PRIVATE KEY-----",
        "hub_token": "ghp_" + "a" * 36,
        "chat_token": "xoxb-1234567890ab",
        "payment_key": "sk_live_" + "4" * 20,
        "cloud_key": "AIza" + "b" * 35,
        "web_token": "eyJ" + "a" * 12 + ".eyJ" + "b" * 12 + ".ccccc",
        "url_login": "ftp://me:secret1@host",
    }

    def meets(query, text):
        if query is None or isinstance(query, bytes):
            return query is None or query in text
        return (all if query[0] == "and" else any)(meets(part, text) for part in query[1])

    for rule in secrets.RULES:
        query, text = secrets.trigram_query(rule.pattern), examples[rule.kind]
        assert re.search(rule.pattern, text), rule.kind
        assert meets(query, text.lower().encode()), (rule.kind, query)
        assert (query is None) == (rule.kind == "hex"), rule.kind


def test_index_finds_what_a_full_scan_finds(spark, odd):
    texts = ["Token: abcdef9", "to ken: abcdef", "TOKEN", None, "", "ghp_" + "Q" * 36 + " AKIA" + "0" * 16]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for given_docs in (docs, odd):
        for row in secrets.find_secrets(given_docs.select("doc_id", "text")).collect():
            assert all(s.end > s.start for s in row.found)
    rows = {r.doc_id: [(s.kind, s.start, s.end) for s in r.found] for r in secrets.find_secrets(docs).collect()}
    assert rows == {
        0: [("assign", 0, 14)],
        1: [],
        2: [],
        3: [],
        4: [],
        5: [("hub_token", 0, 40), ("access", 41, 61)],
    }


def test_odd_documents(odd, empty):
    assert secrets.find_secrets(odd).count() == pii.find_personal_data(odd).count() == len(cases.rows())
    assert secrets.find_secrets(empty).count() == pii.find_personal_data(empty).count() == 0
    row = pii.find_personal_data(odd).where("doc_id = 11").first()
    assert [(s.kind, s.end - s.start) for s in row.found] == [("email", 21)]


def test_terms_that_reveal_an_entity(spark):
    """A nickname that only occurs with one address is removed, a common word is left."""
    filler = [cases.prose(i, 40) for i in range(60)]
    rows = [(i, f"{t} plain") for i, t in enumerate(filler)]
    rows += [(100 + i, f"{filler[i]}\nask plain zanzibar at ann@mail.example.org now\n{i}") for i in range(3)]
    rows += [(200, "nobody else"), (201, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = dict(rows)
    found = {r.doc_id: [(s.kind, texts[r.doc_id][s.start : s.end]) for s in r.found] for r in pii.find_personal_data(docs).collect()}
    for i in range(100, 103):
        kinds = dict((value, kind) for kind, value in found[i])
        assert kinds["zanzibar"] == "removed"
        assert kinds["ann@mail.example.org"] == "email"
        assert "plain" not in kinds
    assert not any(found[i] for i in range(60)) and found[200] == found[201] == []
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert "zanzibar" not in clean[100] and "[EMAIL]" in clean[100] and "plain" in clean[100]
    assert clean[200] == "nobody else" and clean[201] is None


def test_an_entity_of_every_document_reveals_nothing(spark):
    texts = [f"write to all@one.example about item{i} and token{i % 2}" for i in range(6)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in pii.find_personal_data(docs).collect():
        assert [s.kind for s in row.found] == ["email"]


@pytest.mark.parametrize("sent", [0, 1, pii.TERMS_SENT])
def test_terms_against_all_pairs(spark, monkeypatch, sent):
    """PMI of every entity and term over all documents, whichever way terms are counted."""
    monkeypatch.setattr(pii, "TERMS_SENT", sent)
    r = random.Random(11)
    texts = []
    for _ in range(160):
        said = [f"word{int(r.paretovariate(0.7)) % 60}" for _ in range(12)]
        who = r.randrange(14)
        if who < 9:
            said.insert(r.randrange(12), f"p{who}@corp.example")
            said += [f"clue{who}"] if r.random() < 0.9 else []
        if who in (2, 5):
            said.append("p1@corp.example")
        texts.append(" ".join(said))
    texts += texts[:9]
    holds = [({w for w in t.split(" ") if "@" in w}, {w for w in t.split(" ") if "@" not in w}) for t in texts]
    n, wanted = len(texts), {}
    for who in {e for es, _ in holds for e in es}:
        mine = [i for i, (es, _) in enumerate(holds) if who in es]
        for term in {w for i in mine for w in holds[i][1]}:
            both = [i for i in mine if term in holds[i][1]]
            if len(both) < pii.LEAST_TOGETHER or len({texts[i] for i in both}) < 2:
                continue
            n_term = sum(term in ts for _, ts in holds)
            share = math.log2(len(both) * n / (len(mine) * n_term)) / math.log2(n / len(mine))
            if share >= pii.GENERALISE_AT:
                for i in both:
                    wanted.setdefault(i, {}).setdefault(term, []).append(share)
    assert 0 < sum(map(len, wanted.values())) < sum(len(ts) for _, ts in holds) / 4
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in pii.find_personal_data(docs).collect():
        found = {texts[row.doc_id][s.start : s.end]: s.kind for s in row.found if s.kind in ("removed", "generalised")}
        mine = wanted.get(row.doc_id, {})
        assert found == {t: "removed" if max(x) >= pii.REMOVE_AT else "generalised" for t, x in mine.items()}


def test_terms_anywhere_in_the_document_reveal_an_entity(spark):
    """A heading far above an address is removed in every document that has both."""
    filler = [cases.prose(i, 40) for i in range(60)]
    rows = [(i, t) for i, t in enumerate(filler)]
    rows += [(100 + i, f"Zanzibar\n{filler[i]}\n{filler[i + 9]}\nask ann@mail.example.org {i}\nzanzibar") for i in range(3)]
    rows += [(200, "onlyhere bob@mail.example.org")]
    found = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    texts = dict(rows)
    by_id = {r.doc_id: [(s.kind, texts[r.doc_id][s.start : s.end]) for s in r.found] for r in found}
    for i in range(100, 103):
        assert ("removed", "Zanzibar") in by_id[i] and ("removed", "zanzibar") in by_id[i]
    # One document's entity has no terms.
    assert by_id[200] == [("email", "bob@mail.example.org")]


@pytest.mark.parametrize("kind,text", [
    ("hub_token", "ghp_" + "a1" * 300),
    ("chat_token", "xoxb-" + "a-1" * 200),
    ("payment_key", "sk_live_" + "Z9" * 300),
    ("url_login", "://" + "u" * 300 + ":" + "p:" * 300 + "@"),
])
def test_long_secrets_are_found_whole(spark, kind, text):
    docs = spark.createDataFrame([(1, f"see {text} there"), (2, f"{text[:-1]} " * 50)], "doc_id long, text string")
    found = {r.doc_id: [(s.start, s.end) for s in r.found if s.kind == kind] for r in secrets.find_secrets(docs).collect()}
    assert found[1] == [(4, 4 + len(text))]
    assert len(found[2]) == (0 if kind == "url_login" else 50)
