from __future__ import annotations

import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

DOCS = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()),
                  ("source", pa.string()), ("n_chars", pa.int64())])
LABELS = pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32())])
ITEMS = pa.schema([("item_id", pa.int64()), ("text", pa.string())])
PAGES = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string())])
VECTORS = pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())),
                     ("label", pa.int32())])


def odd_texts() -> list[str | None]:
    """Nulls, blanks, odd characters, long texts, repeats inside and across texts."""
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abdeéios") for _ in range(rnd.randint(1, 7))) for _ in range(80)]

    def prose(n):
        return " ".join(rnd.choice(words) for _ in range(n))
    passage, line = prose(90), "A line that occurs in MANY documents, word for word."
    item = prose(12)
    texts = [None, "", " ", "\n\n", "a", "é", "日本語 😀 ▁ x", "tab\tand\r\nbreaks \x0b\x0c",
             "x" * 5000, "ab " * 3000, prose(9000), passage, passage, f"{prose(20)} {passage}",
             f"{passage} {prose(20)}", f"  {line.upper()}\t", f"{prose(8)}\n{line}\n{line}",
             f"{line}\n{prose(9)}", line, f"{prose(5)} {item.title()} {prose(5)}", item]
    texts += [prose(rnd.randint(1, 120)) for _ in range(12)]
    near = prose(400)
    texts += [near, near + " ende", near]
    return texts


def odd_item(texts) -> str:
    return texts[20]


@pytest.fixture
def write(tmp_path):
    """Write tables as the queries expect them; returns the folder."""
    def put(more: dict | None = None, **tables):
        schemas = {"documents": DOCS, "labels": LABELS, "benchmark": ITEMS, "pages": PAGES,
                   "embeddings": VECTORS}
        for name, schema in schemas.items():
            rows = [dict(zip(schema.names, r)) for r in tables.get(name, [])]
            table = pa.Table.from_pylist(rows, schema=schema)
            for column, kind in (more or {}).get(name, {}).items():
                table = table.append_column(column, pa.nulls(len(rows), kind))
            pq.write_table(table, tmp_path / f"{name}.parquet")
        return str(tmp_path)
    return put


@pytest.fixture
def odd_tables(write):
    """All tables with odd rows, null ids, repeated rows, and extra columns of clashing names."""
    texts = odd_texts()
    langs = ["en", "fr", None]
    docs = [(i, t, langs[i % 3], f"src{i % 2}", None if t is None else len(t))
            for i, t in enumerate(texts)]
    items = [(1, odd_item(texts)), (2, None), (3, ""), (4, "word"), (1, odd_item(texts)),
             (None, "another item without a number of its own here now yes")]
    pages = [(1, "http://www.Example.com/en/a?q#f", ""), (2, None, None), (3, "no scheme", ""),
             (4, "https://a.net/es/", ""), (5, "x://b.net", ""), (5, "x://b.net", ""),
             (None, "ftp://example.com/en/", ""), (6, "a://" + "h." * 400 + "com/x", "")]
    labels = [(i, i % 2, None if i == 3 else int(i % 5 == 0)) for i in range(len(texts))]
    rnd = random.Random(2)
    vectors = [(i, [rnd.gauss(0, 1) for _ in range(8)], 0) for i in range(150)]
    vectors += [(150, None, 0), (151, [0.0] * 8, 0), (152, [float("nan")] * 8, 0),
                (153, [1.0, None] * 4, 0), (154, [1.0], 0), (None, [1.0] * 8, 0),
                *[(200 + i, [1.0] * 8, 0) for i in range(30)], (200, [1.0] * 8, 0)]
    clash = {"documents": {"id": pa.string(), "raw": pa.int32(), "carried": pa.int32(),
                           "fp": pa.int32(), "k1": pa.string(), "row": pa.string()},
             "benchmark": {"item": pa.int32(), "window": pa.int32(), "doc_id": pa.int64()},
             "pages": {"id": pa.int32(), "host": pa.int32(), "key": pa.int32()},
             "labels": {"label": pa.int32(), "id": pa.int32()},
             "embeddings": {"id": pa.int32(), "raw": pa.int32(), "node": pa.int32()}}
    return write(clash, documents=docs, benchmark=items, pages=pages, labels=labels,
                 embeddings=vectors)
