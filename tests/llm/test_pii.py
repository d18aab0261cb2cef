import hashlib
import math
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pagemill.llm import pii

#: The contract's patterns, searched by the standard engine.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                  "card": lambda: 14 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 10 <= len(digits) <= 15}[kind]()
            if ok:
                out.append((m.start(), k, m.end()))
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


TEXTS = [
    None, "", "no data", "a.b@c.de_d@e.fg x@y z@y.x. @a.b .@-.-", "1.2.3.4.5.6.7.8 256.1.1.1 0255.0.0.00001 1.2.3 9.9.9.9",
    "4111 1111 1111 1111 x 4111-1111-1111-1112 378282246310005 30569309025904 7", "+49 151 234 5678 90 +1(2)3 +49-(30) 1234 567.",
    "😀 é +1 (017) 555-7713 😀 4929348385146306 mail@host.example", "1" * 5000, "a" * 5000, "a@" * 2000, "+1" * 2000,
    "1 " * 3000, "x" * 3000 + "@a.b" + ".c" * 2000, "4111111111111111" * 3, "+1234567890 4111111111111111@x.y 1.1.1.1@2.2.2.2",
]


@pytest.mark.parametrize("case", range(2))
def test_base_spans_match_brute_force(spark, case):
    rows = [(i, t, "c") for i, t in enumerate(TEXTS)] + [(None, TEXTS[3], "c"), (3, TEXTS[3], "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, base string")
    got = pii.digest_columns(pii.personal_data(df)).collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute(TEXTS[3] if r["id"] is None else TEXTS[r["id"]])
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), TEXTS[r["id"] or 3]
        assert r["spans"] == want and r["n_term"] == 0
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [want.count(f"{k}:") for k in pii.KINDS]


def corpus():
    """An address that always comes with one rare surname, among texts that never have it; a
    frequent word that comes with it as often tells little."""
    rows = [(i, f"filler{chr(97 + i)} said that zyxwork wrote to boss@corp.example about matter{chr(107 + i)} and the thing")
            for i in range(6)]
    rows += [(100 + i, f"text {i} about the thing and other matter number{i}") for i in range(300)]
    return rows


def test_disclosing_terms_are_found_and_sanitised(spark):
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(corpus())], "doc_id long, text string, start int")
    spans = {r["id"]: r for r in pii.personal_data(df).collect()}
    terms = {spans[0]["terms"][i]["value"] or "gone" for i in range(len(spans[0]["terms"]))}
    words = {corpus()[0][1][s["start"]:s["end"]] for s in spans[0]["terms"]}
    assert "zyxwork" in words and "thing" not in words and "about" not in words
    assert terms  # generalised or gone
    assert not spans[100]["spans"]
    out = {r["doc_id"]: r["text"] for r in pii.sanitise(df).collect()}
    assert "[EMAIL]" in out[0] and "boss@corp" not in out[0] and "zyxwork" not in out[0]
    assert out[100] == corpus()[6][1] and len(out) == len(corpus())


def words_of(spans, text):
    return {text[s["start"]:s["end"]].lower() for s in spans}


@pytest.mark.parametrize("told", ["two", "far", "short", "heading"])
def test_terms_are_found_wherever_they_stand(spark, told):
    """A name told by two texts, far from the address, of three letters, and in a heading that is kept otherwise."""
    name = "Lee" if told == "short" else "Zyxwork"
    filler = " ".join("the other matter about text number thing and".split() * (5 if told == "far" else 1))
    head = f"{name}\n\n" if told == "heading" else ""
    rows = [(i, f"{head}note{chr(97 + i)} {name} {filler} boss@corp.example end") for i in range(2)]
    rows += [(100 + i, f"note the other matter about text number{i} thing and end") for i in range(300)]
    got = {r["id"]: r for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert words_of(got[0]["terms"], rows[0][1]) == {name.lower()}
    assert len(got[0]["terms"]) == 1 + (told == "heading")
    assert not any(r["terms"] for i, r in got.items() if i >= 100)


def test_rare_addresses_are_pooled_over_their_domain(spark):
    rows = [(i, f"person{chr(97 + i)}@acme.example wrote from Qwyx about thing{chr(97 + i)}") for i in range(8)]
    rows += [(100 + i, f"someone wrote from there about text number{i}") for i in range(300)]
    got = {r["id"]: r for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(words_of(got[i]["terms"], rows[i][1]) == {"qwyx"} for i in range(8))


def brute_scores(texts, disclosure):
    """The pairs beyond the threshold, counted plainly over sets of words."""
    def tokens(text):
        keep = re.sub(PATTERNS["email"], lambda m: " " * len(m[0]), text)
        return {w.lower() for w in re.findall(r"[^\W\d_]+", keep)}

    texts = set(texts)
    terms = {t: {x for w in tokens(t) for x in ((w, w[:3] + "*") if len(w) > 3 else (w,))} for t in texts}
    mails = {t: {m[0].lower() for m in re.finditer(PATTERNS["email"], t)} for t in texts}
    total = len(texts)

    def share(both, with_term, with_entity, n):
        p = both / max(with_term, 1)
        m = max(with_term, 1)
        low = (p + 0.5 / m - math.sqrt(p * (1 - p) / m + 0.25 / m ** 2)) / (1 + 1 / m)
        of = math.log2(n / max(with_entity, 1))
        return min(max(math.log2(low * n / with_entity) / of, 0), 1) if both and low > 0 and of > 0 else 0

    found = set()
    for e in set().union(*mails.values()):
        holds = {t for t in texts if e in mails[t]}
        rest = {t for t in texts if any(m.split("@")[1] == e.split("@")[1] for m in mails[t])} - holds
        for w in set().union(*(terms[t] for t in holds)):
            has = {t for t in texts if w in terms[t]}
            c, r = len(holds & has), len(rest & has)
            prior = r / (r + 1) * share(r, len(has) - c, len(rest), total - len(holds))
            if (c * share(c, len(has), len(holds), total) + prior) / (c + 1) >= disclosure:
                found.add((f"0:{e}", w))
    return {(e, w, None if (e, w[:3] + "*") in found or len(w) < 4 else w[:3] + "*") for e, w in found if w[-1] != "*"}


@given(st.lists(st.lists(st.sampled_from(["aa", "bbbb", "bbbc", "ccccc", "d", "m@x.yz", "n@x.yz", "o@v.w", "É.", "eé1"]),
                         min_size=1, max_size=5), min_size=1, max_size=25))
@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
def test_disclosing_pairs_match_brute_force(spark, parts):
    texts = [" ".join(p) for p in parts] + ["f g", "f h", "bbbb q", "g i j"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = pii.disclosing_terms(df, pii.found_spans(df))
    assert {(r["entity"], r["term"], r["generalised"]) for r in got.collect()} == brute_scores(texts, pii.DISCLOSURE)


def test_copies_are_no_evidence(spark):
    rows = [(i, "zyxwork wrote to boss@corp.example again") for i in range(9)] + [(50 + i, f"text {i}") for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(not r["terms"] for r in pii.personal_data(df).collect())


def test_sanitise_edges(spark):
    rows = [(1, None, 5), (None, "call +49 151 234 5678 90 now", 5), (2, "1.1.1.1", 5), (2, "1.1.1.1", 5), (3, "", 5),
            (4, "+1234567890123, 4111111111111111", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __base int")
    out = pii.sanitise(df)
    assert out.columns == df.columns
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    assert got == sorted([(1, None), (None, "call [PHONE] now"), (2, "[IP]"), (2, "[IP]"), (3, ""),
                          (4, "[PHONE], [CARD]")], key=str)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pii.sanitise(empty).count() == 0 and pii.personal_data(empty).count() == 0
