"""Print the executed (AQE final) physical plan of registered queries.

    python -m cartwheel.plans.explain SF_DIR [query ...]

Each query is run once through its own DataFrame so that the adaptive plan is final (stages,
runtime join choices, reused exchanges); long expression lists are shortened.
"""

from __future__ import annotations

import re
import sys

from cartwheel.plans.queries import QUERIES
from cartwheel.session import build_session


def final_plan(df) -> str:
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    final = text.split("== Initial Plan ==")[0]
    out = []
    for line in final.splitlines():
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        out.append(line if len(line) <= 160 else line[:157] + "...")
    return "\n".join(out)


def main(argv: list[str] | None = None) -> None:
    args = sys.argv[1:] if argv is None else argv
    sf_dir, names = args[0], args[1:] or list(QUERIES)
    spark = build_session("local[8]")
    for name in names:
        print(f"### {name}\n\n```\n{final_plan(QUERIES[name](spark, sf_dir))}\n```\n")


if __name__ == "__main__":
    main()
