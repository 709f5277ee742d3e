"""Prompts of questions that share their evidence: texts move and are cut into words once for each task."""

import re

from pyspark.sql import functions as F

from costwatch.functions import text
from costwatch.operators import explain


def _popular(spark):
    docs = [("d0", "one text,\x0bof\r\nmany  words"), ("d1", ""), ("d2", None)]
    asked = [(i, f"question {i}" if i % 5 else None) for i in range(40)] + [(99, "no evidence")]
    hits = [(i, f"d{(i + r) % 3}", r) for i in range(40) for r in (1, 2)]
    return (
        spark.createDataFrame(asked, "query_id long, text string"),
        spark.createDataFrame(hits, "query_id long, document_id string, rank int"),
        spark.createDataFrame(docs, "document_id string, text string"),
    )


def test_texts_move_once_for_each_task(spark, monkeypatch):
    """A text that is evidence of many questions must not be copied for each before the shuffle."""
    questions, hits, docs = _popular(spark)
    prompts = explain.qa_prompts(questions, hits, docs)
    assert "EVIDENCE" not in prompts._jdf.queryExecution().toString()
    body = {r["document_id"]: r["text"] for r in docs.collect()}
    monkeypatch.setattr(explain, "PART_BYTES", 10)
    for made in (prompts, explain.qa_prompts(questions, hits, docs)):
        got = {r["query_id"]: r["prompt"] for r in made.collect()}
        assert got.pop(99) is None and len(got) == 40
        for i, prompt in got.items():
            parts = [explain.ANSWER_RULES] + [f"QUESTION question {i}"] * bool(i % 5)
            for rank in (1, 2):
                t = body[f"d{(i + rank) % 3}"]
                parts.append(f"EVIDENCE {rank}" + ("" if t is None else f"\n{t}"))
            assert prompt == "\n\n".join(parts)


def test_words_of_prompts_are_those_of_their_texts(spark):
    """A text of many prompts is cut into words once for each task, with the count of whole prompts."""
    prompts = explain.qa_prompts(*_popular(spark))
    expected = {r[0]: r[1] for r in prompts.select("query_id", text.word_count(F.col("prompt"))).collect()}
    assert {r["query_id"]: r["prompt_words"] for r in prompts.collect()} == expected
    answers = {r["query_id"]: r["input_tokens"] for r in explain.answer(prompts).collect()}
    assert answers == {q: n or 0 for q, n in expected.items()}
    assert re.findall(r"\S+", explain.ANSWER_RULES) == explain.ANSWER_RULES.split()
