"""Pipeline runner (J1, J2): staging -> intermediate -> marts -> checks.

Each step is a Spark job; tables are written under `out_root` and read back by
later layers, so lineage is cut at every written model and a lost executor only
recomputes from the last written table. A table's new version is committed when it is
whole; until then readers have the last one. The run stops at the first failure and
reports a step summary; the CLI exits non-zero on failure. `--refresh` rebuilds only what new
landed files change (refresh_tables).
"""

from __future__ import annotations

import argparse
import os
import sys
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import SparkSession

from airshed.operators import quality
from airshed.plans import lineage
from airshed.plans.models import LAYERS, MODELS, UNIFIED, Context, Model
from airshed.session import build_session, use_utc
from airshed.sinks import commits
from airshed.sinks.publish import commit, publish_view, read_published, write_version


@dataclass
class Step:
    name: str
    ok: bool
    detail: str


def _selected(select: Iterable[str] | None) -> list[str]:
    if not select:
        return [m for m in MODELS] + ["tests"]
    chosen = []
    for s in select:
        if s == "tests":
            chosen.append("tests")
        elif s in LAYERS:
            chosen += [m.name for m in MODELS.values() if m.layer == s]
        elif s in MODELS:
            chosen.append(s)
        else:
            raise ValueError(f"unknown model or layer: {s}")
    return [m for m in MODELS if m in chosen] + (["tests"] if "tests" in chosen else [])


def run_pipeline(
    spark: SparkSession,
    ctx: Context,
    out_root: str,
    select: Iterable[str] | None = None,
) -> list[Step]:
    """Build the selected models in layer order, then the checks; stop at the first
    failing step. A view is registered; a table is written and read back. What is not
    selected is read from out_root, if an earlier run wrote it there."""
    use_utc(spark)
    ctx.written = out_root
    steps: list[Step] = []
    for name in _selected(select):
        try:
            if name == "tests":
                readings = ctx.ref("int_air_quality_unified").filter("data_type = 'historical'")
                bad = quality.violations(readings, "timestamp")
                failed = {n: c for n, c in bad.items() if c}
                steps.append(Step("tests", not failed, f"violations {bad}"))
            else:
                model = MODELS[name]
                df = ctx.frames[name] = model.build(ctx)
                if model.materialized == "view":
                    publish_view(df, name)
                    steps.append(Step(name, True, "view"))
                else:
                    path = os.path.join(out_root, name)
                    build_table(ctx, model, df, path)
                    ctx.frames[name] = read_published(spark, path)
                    publish_view(ctx.frames[name], name)
                    steps.append(Step(name, True, f"table {path}"))
        except Exception as e:  # noqa: BLE001 - the runner reports and stops
            steps.append(Step(name, False, f"{type(e).__name__}: {e}"))
        if not steps[-1].ok:
            break
    return steps


def build_table(ctx: Context, model: Model, df, path: str, replace: Iterable[str] | None = None) -> None:
    """Write and commit a new version of a model's table; `replace`: of these partitions only. The record
    holds what it was built from: the files and options, and the state of the unified table."""
    draft = write_version(df, path, model.partition_by, model.cluster_by)
    more = {"fingerprint": ctx.fingerprint(model.name)}
    if model.name == UNIFIED:
        more |= lineage.write(ctx, draft, path, replace)
    else:
        more["unified"] = (commits.latest(ctx.spark, os.path.join(ctx.written, UNIFIED)) or (0, {}))[0]
    commit(ctx.spark, draft, replace, **more)


def summary(steps: list[Step], total: int) -> str:
    lines = [f"{'ok ' if s.ok else 'FAIL'} {s.name}: {s.detail}" for s in steps]
    lines.append(f"{sum(s.ok for s in steps)} of {total} steps done")
    return "\n".join(lines)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description="Run the air-quality models on landed raw feeds.")
    p.add_argument("--raw", required=True, help="landing root with historical/, current/, forecast/")
    p.add_argument("--out", required=True, help="output root for written models")
    p.add_argument("--select", nargs="*", help="layers or model names (default: all, then tests)")
    p.add_argument("--as-of", default=None, help="forecast evaluation day (default: today)")
    p.add_argument("--refresh", action="store_true", help="rebuild only what landed files have changed")
    a = p.parse_args(argv)
    spark = build_session(app="airshed-pipeline")
    ctx = Context.from_landing(spark, a.raw, as_of=a.as_of)
    if a.refresh:
        from airshed.plans.refresh import refresh_tables

        steps = refresh_tables(spark, ctx, a.out)
        print(summary(steps, len(steps)))
        return 0 if all(s.ok for s in steps) else 1
    steps = run_pipeline(spark, ctx, a.out, a.select)
    print(summary(steps, len(_selected(a.select))))
    return 0 if all(s.ok for s in steps) and len(steps) == len(_selected(a.select)) else 1


if __name__ == "__main__":
    sys.exit(main())
