import hashlib
import re
from collections import defaultdict

from lagscope.llm.base import table
from lagscope.llm.exact_dedup import OpenTable, exact_dedup

from .cases import ODD, no_documents, odd_documents

SF = "/root/testdata/sf0.001"


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), i == keep, sha) for i in ids]
    return sorted(out, key=repr)


def found(docs, **options):
    return sorted((tuple(r) for r in exact_dedup(docs, **options).collect()), key=repr)


def test_a_table_compares_contents():
    table_ = OpenTable()
    for content in [*(f"text {i}" for i in range(3000)), "other"]:
        entry, at = table_.find(7, content)
        assert entry == -1
        table_.add(7 if len(content) < 7 else hash(content), content, at)
        if len(table_.contents) > 40:
            break
    # Equal hashes, different contents.
    assert table_.find(7, "text 1")[0] == 1 and table_.find(7, "never")[0] == -1


def test_documents(spark):
    docs = table(spark, SF, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert found(docs) == expected(rows)


def test_odd_documents_and_full_tables(spark):
    docs = odd_documents(spark).repartition(3)
    rows = [r[:2] for r in ODD]
    assert found(docs) == expected(rows)
    # Tables that take a few texts only: most records are spilled, again and again.
    assert found(docs, table_bytes=300) == expected(rows)


def test_no_documents(spark):
    assert exact_dedup(no_documents(spark)).count() == 0
