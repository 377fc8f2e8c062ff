"""Whole texts whose line breaks have white space or marks beside them."""

from tidewatch.llm import licences


def test_anchors_across_line_breaks(spark):
    texts = ["All rights\r\nreserved.", "All rights\n   reserved.", "# All rights\n# reserved.", "All rights\n\nreserved."]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = sorted((r.doc_id, r.line_no, r.licence, r.dice, r.evidence) for r in licences.licence_scan(table).collect())
    assert found == [(i, 0, "proprietary", 1.0, t) for i, t in enumerate(texts)]
