"""How often line dedup takes the texts apart."""

from maintlake.llm import op2_lines


def test_removed_lines_are_found_without_taking_the_texts_apart_again(spark):
    line = "a line of more than twenty characters"
    docs = spark.createDataFrame([(1, f"{line}\nü"), (2, f"{line}\n\n日本\n{line[:-1]}"), (3, None)], "doc_id long, text string")
    out = op2_lines.repeated_lines(docs)
    assert "MapInArrow" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {r.doc_id: r.removed for r in out.collect()} == {1: [], 2: [0, 3], 3: []}
