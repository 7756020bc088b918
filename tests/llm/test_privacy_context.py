"""Context of candidates and the rule by which they are added."""

from __future__ import annotations

from scalargrid.llm import privacy


def test_context_reaches_through_earlier_matches(spark):
    texts = ["call 555-123-4567 or 555-987-6543", "call 1-22-333 1-22-334, 1-22-335; 1-22-336", "x" * 50 + " a@b.c,d@e.f " + "y" * 60 + " g@h.i"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = privacy.spans_of(privacy.found(docs)).where("NOT base").collect()
    rids = {r["rid"]: r["doc_id"] for r in privacy.found(docs).collect()}
    assert len([s for s in spans if s["kind"] == "phone"]) >= 4
    for s in spans:
        text = texts[rids[s["rid"]]]
        assert text[s["start"] : s["end"]] == s["match"] and s["before"] == text[max(0, s["start"] - 40) : s["start"]]
    votes = privacy.voted(privacy.spans_of(privacy.found(docs)).where("NOT base AND kind = 'phone'")).collect()
    assert {v["context"] for v in votes} == {1}


def test_a_free_card_needs_no_context_word(spark):
    good = "seen 378282246310005 there"  # 15 digits, Luhn holds, known issuer: no base span
    rows = [(i, good) for i in range(40)] + [(100 + i, "seen 978282246310004 there") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    _, spans = privacy.personal_spans(docs)
    found = spans.where("kind = 'card'").select("start", "end").collect()
    assert len(found) == 40 and {tuple(r) for r in found} == {(5, 20)}
