import ast
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parents[1]


def _imports(path):
    for node in ast.walk(ast.parse(path.read_text(encoding="utf-8"))):
        if isinstance(node, ast.Import):
            yield from (a.name for a in node.names)
        elif isinstance(node, ast.ImportFrom):
            yield node.module or ""


def test_core_does_not_need_the_subpackage():
    for path in (ROOT / "pollweave").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert not [m for m in _imports(path) if m.startswith("pollweave.llm")], path


def test_queries_and_sql():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and {"p1_found", "p2_found", "topn_share_15"} <= set(queries)
    assert all(callable(q) for q in queries.values())


def test_no_invisible_characters_in_sources():
    odd = {chr(c) for c in (*range(0x200B, 0x2010), *range(0x2028, 0x2030), *range(0x2060, 0x2070), 0xFEFF, 0xAD, 0xA0)}
    for path in [*(ROOT / "pollweave").rglob("*.py"), *ROOT.glob("*.py")]:
        assert not odd & set(path.read_text(encoding="utf-8")), path


def test_nothing_is_put_in_temporary_folders():
    for path in (ROOT / "pollweave").rglob("*.py"):
        assert "tempfile" not in _imports(path) and "localCheckpoint" not in path.read_text(encoding="utf-8"), path
