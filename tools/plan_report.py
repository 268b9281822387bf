"""Write PLANS.md: the physical plan shape of every registered query.

Plans are built as on a large cluster: Spark's automatic broadcast is off (at
100 TB only the fixed broadcasts remain), so the
report shows the shuffles a big run performs. Usage:

    python tools/plan_report.py [sf_dir] [out.md]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wardlens.plans.catalog import QUERIES, WRITING  # noqa: E402
from wardlens.session import build_session  # noqa: E402

# The plans of the others that write are reads of what they have written.
SKIP = WRITING - {"orphans", "null_violations", "length_violations", "key_report",
                  "indicators_many_periods"}


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def _clean(s: str) -> str:
    return re.sub(r"#\d+L?", "", s)


def _dedupe_subqueries(lines: list[str]) -> list[str]:
    """Drop repeated copies of the same scalar subquery (printed once per
    reference, executed once)."""
    out, seen, i = [], set(), 0
    while i < len(lines):
        ln = lines[i]
        if ln.lstrip(" :|+-").startswith("Subquery subquery"):
            indent = len(ln) - len(ln.lstrip(" :|+-"))
            block = [ln]
            j = i + 1
            while j < len(lines) and len(lines[j]) - len(lines[j].lstrip(" :|+-")) > indent:
                block.append(lines[j])
                j += 1
            key = "\n".join(b.strip(" :|+-") for b in block)
            if key not in seen:
                seen.add(key)
                out.extend(block)
            i = j
            continue
        out.append(ln)
        i += 1
    return out


def summarize(text: str) -> dict:
    lines = _dedupe_subqueries([_clean(ln) for ln in text.splitlines()])
    scans, shuffles, joins, aggs = [], [], [], {}
    for ln in lines:
        if "FileScan parquet" in ln:
            table = re.search(r"/([A-Za-z_]+)\.parquet\]", ln)
            cols = re.search(r"FileScan parquet \[([^\]]*)\]", ln)
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", ln)
            scans.append((table.group(1) if table else "?",
                          len(cols.group(1).split(",")) if cols and cols.group(1) else 0,
                          [p for p in re.split(r", (?=[A-Z])", pushed.group(1))
                           if p and not p.startswith("IsNotNull")] if pushed else []))
        m = re.search(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)"
                      r"(\(([^)]*?), \d+\))?", ln)
        if m and "BroadcastExchange" not in ln:
            kind = m.group(1)
            keys = m.group(3) or ""
            if kind.startswith("range"):
                keys = ", ".join(k.split(" ")[0] for k in keys.split(", "))
            shuffles.append("single" if kind == "SinglePartition" else
                            (f"range({keys})" if kind.startswith("range") else f"hash({keys})"))
        m = re.search(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|"
                      r"BroadcastNestedLoopJoin|CartesianProduct) (\[[^\]]*\])?,? ?"
                      r"(\[[^\]]*\])?,? ?(Inner|LeftOuter|LeftSemi|LeftAnti|RightOuter|FullOuter)?",
                      ln)
        if m:
            joins.append(f"{m.group(1)} {m.group(4) or ''} {m.group(2) or ''}".strip())
        for a in ("HashAggregate", "SortAggregate", "ObjectHashAggregate", "WindowGroupLimit",
                  "TakeOrderedAndProject", "Window ", "Generate"):
            if re.search(rf"\b{a}", ln):
                aggs[a.strip()] = aggs.get(a.strip(), 0) + 1
    return {"scans": scans, "shuffles": shuffles, "joins": joins, "ops": aggs}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(
        os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    spark = build_session("local[8]", shuffle_partitions=200, extra={
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    md = ["# Physical plans of the registered queries", "",
          "Generated by `tools/plan_report.py` from `explain()` with Spark's automatic",
          "broadcast disabled, i.e. the shape of a run where every fact table is large;",
          "the only broadcasts left are those of fixed size. Columns:",
          "tables scanned (columns read; filters pushed into the Parquet reader beyond",
          "not-null), shuffles (exchange partitioning keys), joins, and other operators.",
          "These are the plans before execution: identical subtrees that adaptive",
          "execution runs once (e.g. the per-day aggregate of `readmission_rate`,",
          "listed twice here and shown as a `ReusedExchange` in the executed plan;",
          "pinned by `tests/test_plans.py`) still appear once per use.",
          "", "| Query | Scans | Shuffles | Joins | Operators |", "|---|---|---|---|---|"]
    for name, fn in QUERIES.items():
        if name in SKIP:
            continue
        s = summarize(_plan(fn(spark, sf_dir)))
        scans = "<br>".join(f"{t} ({n} cols{'; ' + ', '.join(p) if p else ''})"
                            for t, n, p in s["scans"])
        shuffles = "<br>".join(s["shuffles"]) or "—"
        joins = "<br>".join(s["joins"]) or "—"
        ops = ", ".join(f"{k}×{v}" for k, v in sorted(s["ops"].items())) or "—"
        md.append(f"| `{name}` | {scans} | {shuffles} | {joins} | {ops} |")
    spark.stop()
    with open(out, "w") as f:
        f.write("\n".join(md) + "\n")
    print("wrote", out)


if __name__ == "__main__":
    main()
