"""Contexts of the language model across words against a plain tree."""

import pytest
from pyspark.sql import functions as F

from lumenmart.llm import ctw
from tests.llm.test_scores import TEXTS, PlainTree, words


def running(text):
    data = (" " * ctw.DEPTH + "".join(w + " " for w in words(text)) + "\n").encode()
    return [data[i : i + ctw.DEPTH + 1] for i in range(len(data) - ctw.DEPTH)]


def test_contexts_cross_words(documents):
    held = (5, 6)
    rows = {r.doc_id: r for r in ctw.score(documents(TEXTS), F.col("doc_id").isin(*held), across_words=True).collect()}
    tree = PlainTree([(running(t), int(i not in held)) for i, t in enumerate(TEXTS)])
    for i, text in enumerate(TEXTS):
        assert rows[i].score == pytest.approx(sum(map(tree.log10, running(text))), rel=1e-4)
