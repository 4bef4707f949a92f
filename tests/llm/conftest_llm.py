"""Helpers of these tests."""


def by_id(rows, source):
    """Each result row beside a text of its id (repeated ids have equal texts here)."""
    texts = {r.doc_id: r.text for r in source.select("doc_id", "text").collect()}
    return [(r, texts[r.doc_id]) for r in rows]
