"""Write the executed physical plans of the headline queries to PLANS.md.

    python tools/show_plans.py [sf_dir] > PLANS.md

Each query is run once (collected) so its adaptive plan is final, then the plan
is printed with the number of exchanges and Python operators in it.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

QUERIES = ["num_normalized", "num_stats", "wc_direct", "wc_salted", "wc_partition", "wc_grouped", "wc_per_doc",
           "wc_distinct", "vec_distance", "vec_assign", "vec_weights", "pick_race", "pick_prefix", "lloyd_step",
           "kmedian_coreset", "mr_kmedian", "row_index", "page_rows"]


def final_only(plan: str) -> str:
    """Drop AQE's '== Initial Plan ==' sections, keeping the final plans."""
    out, skip_indent = [], None
    for line in plan.splitlines():
        indent = len(line) - len(line.lstrip(" +-:|"))
        if skip_indent is not None:
            if indent >= skip_indent:
                continue
            skip_indent = None
        if "== Initial Plan ==" in line:
            skip_indent = indent
            continue
        out.append(line)
    return "\n".join(out)


def main() -> None:
    from tessera.plans import catalog as Q
    from tessera.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    print("# Physical plans of the headline queries\n")
    print(f"Generated by `tools/show_plans.py` on `{os.path.basename(sf_dir)}`, `local[8]`, AQE on; "
          "final adaptive plans after one run (AQE's initial plans omitted).\n")
    for name in QUERIES:
        df = Q.QUERIES[name](spark, sf_dir)
        df.collect()  # same query execution, so the adaptive plan below is the final one
        plan = final_only(re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString()))
        exchanges = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)",
                                   plan))
        python = len(re.findall(r"ArrowEvalPython|MapIn(?:Pandas|Arrow)|FlatMapGroupsIn(?:Pandas|Arrow)", plan))
        print(f"## {name}\n\nshuffle exchanges: {exchanges}, Python operators: {python}\n")
        print("```\n" + plan.strip() + "\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
