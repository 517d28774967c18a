import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Rows of (doc_id, text) as documents, with further columns whose names the operators use inside."""

    def build(rows):
        extra = "row_key string, text_key string, set_key string, cell string, size string, n_removed string, share string"
        none = (None,) * 7
        return spark.createDataFrame(
            [(i, text, "xx", "src", None, *none) for i, text in rows],
            f"doc_id bigint, text string, lang string, source string, n_chars bigint, {extra}",
        )

    return build


def reachable(nodes, links):
    """The smallest node that each node reaches."""
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    return root
