"""Write PLANS.md: the executed physical plan shape of every registered query.

python tools/plan_report.py [sf_dir]   (default /root/testdata/sf0.1)
For each query: shuffles, joins and their strategy, Python nodes, generators,
windows, and what reaches each parquet scan (pushed filters, read schema).
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from logwise.plans.catalog import QUERIES  # noqa: E402
from logwise.session import build_session  # noqa: E402

NODES = [
    ("shuffle", r"Exchange (hashpartitioning\([^)]*\)|SinglePartition|RoundRobinPartitioning\(\d+\))"),
    ("broadcast", r"BroadcastExchange|Exchange HashedRelationBroadcastMode"),
    ("join", r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)"),
    ("python", r"(ArrowEvalPython|MapInPandas|BatchEvalPython)"),
    ("generate", r"Generate (\w+)"),
    ("window", r"\bWindow\b"),
    ("expand", r"\bExpand\b"),
]


# What each plan does at 100 TB (written by hand; the plan shapes below are generated).
AT_SCALE = {
    "log_records": "Map-only: line built and split once per row (generator), no shuffle once the scan is wide (spread is a no-op).",
    "error_logs": "Map-only; the level predicate and the 3-column projection reach the parquet scan, so row groups without errors are skipped by statistics.",
    "error_logs_sql": "Same plan as error_logs: the SQL over the batch is optimized by Catalyst like the DataFrame form.",
    "error_log_stream": "Text files written once per input task, then one file-stream batch per N files; parse + filter are map-only; the parquet file sink commits each batch exactly once, no directory per batch.",
    "level_totals": "One shuffle of partial counts (one row per key per map task); a key with a third of all rows costs no more than any other.",
    "level_totals_from_lines": "Map-only line building, then the same partial-count shuffle as level_totals.",
    "level_totals_stream": "Stateful count with state partitions fixed at first start; complete mode writes all keys per batch (keys are the 4-5 levels); read back from one batch partition.",
    "level_total_snapshots": "Input scanned once into per-(batch, key) counts, checkpointed; windows run per (key, 4096-batch block), so no task holds more than 4096 rows of one key; output is keys x batches by definition, the interval form has one row per change.",
    "sliding_level_counts": "Each row expands into 2 windows before the partial aggregate; shuffle volume is windows x keys per map task, independent of row count.",
    "sliding_level_counts_stream": "Every batch aggregates its own rows into window contributions (two windows per row before the partial aggregate); no state, no watermark, nothing dropped; the reader sums windows x keys x batches rows in one shuffle.",
    "sliding_level_counts_3_2": "As sliding_level_counts with a non-multiple length; rows outside a window are filtered inside the expansion.",
    "tumbling_counts": "One window per row, partial aggregate, one shuffle of window x key rows.",
    "dictionary_words": "Explode + distinct with map-side dedup; the shuffle carries each word at most once per map task.",
    "word_counts": "Literal list: array_intersect per comment, so only matched words are exploded; partial counts per word before the one shuffle.",
    "comment_word_counts": "As word_counts, through the application entry point, grouped by word and language (empty comments dropped in the scan stage).",
    "segment_spaces_counts": "Dictionary measured first (one aggregate); under the limit a broadcast semi-join filters tokens before the partial count; over it tokens are counted per word first and joined after, so a hot word is never one task's work.",
    "segment_dictionary_counts": "Forward maximum matching by one prefix-tree regex (cost per position is the length of the match, not the number of words); map-only until the per-word partial count.",
    "segment_dictionary_frame_counts": "Dictionary frame measured, collected within the pattern limits and folded into one regex as above; beyond them the substrings of each word length are semi-joined with it (after a filter on beginnings), the longest per position aggregated and picked left to right per comment.",
    "segment_ngrams_counts": "<= 8 literal words: one JVM contains per word per comment, then the partial count; no explode of n-grams.",
    "segment_ngrams_dictionary_counts": "Within the pattern limits one prefix-tree regex per nesting level finds every word at every character, distinct per comment before the partial count; beyond them n-grams of one length at a time that begin like a word (the beginnings measured, then part of the pattern) are aggregated and semi-joined with the dictionary. No Python.",
    "comment_word_counts_stream": "Per micro-batch: dictionary snapshot reused until its TTL, comments spread only when the batch is narrow, broadcast/aggregate-first join as above, one ledger partition per batch (replay-safe).",
    "monthly_counts": "Half-day batches of contributions, rebalanced by (month, batch) so that a small batch is one file and a large one is split; two compactions, each adding the batches after its month's mark to a new version; marks are one row per month and joined without a hint.",
    "accumulate_counts": "Two aggregates unioned and summed in one more aggregate: no sort-merge join; both inputs are already hash-partitioned on (word, date), so the union needs no extra exchange.",
    "service_terms": "Map-only: the response is parsed once per row inside a one-row generator (a filter would otherwise copy from_json once per field reference).",
    "enriched_terms": "Answers parsed once per row inside a one-row generator; the measured dictionary is broadcast and filters terms before the partial count.",
    "format_epochs": "Map-only field formatting.",
}


def summarize(plan: str) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for name, pat in NODES:
        hits = [m.group(0) for m in re.finditer(pat, plan)]
        if hits:
            out[name] = hits
    scans = []
    for m in re.finditer(r"FileScan parquet [^\n]*", plan):
        line = m.group(0)
        loc = re.search(r"Location: \w+(?:\(\d+ paths\))?\[([^\]]*)\]", line)
        pushed = re.search(r"PushedFilters: (\[[^\]]*\])", line)
        schema = re.search(r"ReadSchema: (struct<[^>]*>)", line)
        src = os.path.basename(loc.group(1).rstrip("/")) if loc else "?"
        if "logwise/" in line:
            src = "(own sink) " + src.split("-")[0]
        scans.append(f"{src}: pushed {pushed.group(1) if pushed else '[]'}, reads {schema.group(1) if schema else '?'}")
    out["scans"] = scans
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=8, extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    lines = [
        "# Physical plans of the registered queries",
        "",
        f"Generated by `tools/plan_report.py` on `{sf_dir}` (local[8], AQE on): the final",
        "adaptive plan after one execution. Streaming keys show the plan that reads their",
        "sink back; their streaming plans are the same operators per micro-batch.",
        "An `Exchange hashpartitioning(doc_id|event_id, N)` marked REPARTITION_BY_NUM is the",
        "narrow-scan spread (the test files are single parquet row groups); it is not planned",
        "when the scan already has as many partitions as the cluster has task slots.",
        "",
    ]
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarize(plan)
        lines.append(f"## `{name}`")
        lines.append("")
        if name in AT_SCALE:
            lines.append(f"At 100 TB: {AT_SCALE[name]}")
            lines.append("")
        shuffles = s.get("shuffle", [])
        lines.append(f"- shuffles: {len(shuffles)}" + (f" ({'; '.join(sorted(set(shuffles)))})" if shuffles else ""))
        for key in ("join", "broadcast", "python", "generate", "window", "expand"):
            if key in s:
                lines.append(f"- {key}: {', '.join(sorted(set(s[key])))}")
        for scan in s["scans"]:
            lines.append(f"- scan {scan}")
        lines.append("")
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(lines))
    spark.stop()


if __name__ == "__main__":
    main()
