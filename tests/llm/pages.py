"""Small page tables for the tests."""

SCHEMA = "id string, source_id string, raw_markdown string, analysis_notes string, title string, url string, created_at timestamp, page_id string, text string, h long, n int, host string, story string"


def articles(spark, rows):
    """rows: dicts; the columns that clash with internal names are filled with noise."""
    noise = {"page_id": "clash", "text": "clash", "h": 1, "n": 2, "host": "clash", "story": "clash"}
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple((noise | r).get(c) for c in names) for r in rows], SCHEMA)
