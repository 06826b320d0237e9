"""What is sent whole to all executors: never rows that come out of Arrow batches, whose number Spark doesn't know."""

from maintlake.llm import op11_variants


def sent_unmeasured(df) -> list[str]:
    """The operators below each broadcast, down to the first shuffle (after which the size is known)."""
    found, depth = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        name = line.lstrip(" :+-*")
        at = len(line) - len(name)
        if depth is not None and at <= depth:
            depth = None
        if depth is None and name.startswith("BroadcastExchange"):
            depth = at
        elif depth is not None and name.startswith("Exchange"):
            depth = None
        elif depth is not None:
            found.append(name.split()[-1] if name.startswith("(") else name.split()[0])
    return found


def test_signatures_are_shuffled_and_never_sent(spark):
    # the shared signatures of these take more bytes than the words, from which the signatures' own size is guessed
    words = spark.createDataFrame([(f"{a}{b}bcdefgh", 2) for a in "abcdefghijklmnopqrst" for b in "abcdefghijklmnopqrst"], "word string, n long")
    near = op11_variants.near_words(words, 7, 4096)
    assert "MapInArrow" not in sent_unmeasured(near)
    assert near.filter("word = 'acbcdefgh'").count() == 2 * 19  # either of the first two letters replaced


def test_forms_are_followed_without_sending_words(spark, monkeypatch):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("d", "e")], "word string, form string")
    plans, saved = [], op11_variants.saved
    monkeypatch.setattr(op11_variants, "saved", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or saved(df))
    assert {tuple(r) for r in op11_variants.last_forms(links).collect()} == {("a", "c"), ("b", "c"), ("d", "e")}
    assert len(plans) > 1 and not any("Broadcast" in plan for plan in plans)
