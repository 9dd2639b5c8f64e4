"""Command line of the jobs: python -m webloom.cli JOB --option value ..."""

from __future__ import annotations

import argparse
import json
import re
import sys
from collections.abc import Sequence

from webloom.config import Authority, Seed, load_pipeline, with_overrides
from webloom.errors import ConfigError, WebloomError
from webloom.session import build_session, ship_package

RUN_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]{0,63}")


def run_name(value: str) -> str:
    """A run's name goes into paths, so it is letters, digits, dots, dashes and underscores."""
    if not RUN_NAME.fullmatch(value):
        raise argparse.ArgumentTypeError(f"not a run name: {value!r}")
    return value


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="webloom", description="Web-link analytics jobs")
    jobs = p.add_subparsers(dest="job", required=True)

    def job(name: str, *needed: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        for n in needed:
            sub.add_argument(f"--{n}", required=True)
        return sub

    job("ingest", "vertices-tsv", "edges-tsv", "vertices-out", "edges-out")
    job("count-lines", "path")
    for name, more in (("pagerank", ()), ("authority", ("seed",))):
        sub = job(name, "vertices", "edges", "out", "crawl", *more)
        sub.add_argument("--config")
        sub.add_argument("--damping", type=float)
        sub.add_argument("--tol", type=float)
        sub.add_argument("--max-iter", type=int)
        sub.add_argument("--n-vertices", type=int)
        sub.add_argument("--edge-partitions", type=int)
        sub.add_argument("--checkpoint-every", type=int, default=4)
        if more:
            sub.add_argument("--seed-size", type=int)
            sub.add_argument("--seed-weight")
    sub = job("backlinks", "list", "out", "crawl")
    sub.add_argument("--prefix", default="")
    sub.add_argument("--run-id", type=run_name, default="run")
    job("mart", "pagerank", "authority", "out")
    sub = job("overlap", "pagerank", "reference", "out")
    sub.add_argument("--crawl")
    sub = job("publish", "mart", "out")
    sub.add_argument("--top-n", type=int, default=100_000)
    sub.add_argument("--window-id")
    sub.add_argument("--dataset-id")
    sub.add_argument("--release-tag")
    sub = job("graph-stats", "vertices", "edges")
    return p


def main(argv: Sequence[str] | None = None) -> int:
    a = parser().parse_args(argv)
    from webloom.plans import jobs

    try:
        spark = build_session(f"webloom-{a.job}")
        ship_package(spark)
        if a.job == "ingest":
            jobs.ingest(spark, a.vertices_tsv, a.edges_tsv, a.vertices_out, a.edges_out)
        elif a.job == "count-lines":
            print(jobs.count_index_lines(spark, a.path))
        elif a.job in ("pagerank", "authority"):
            config = load_pipeline(a.config) if a.config else None
            p = with_overrides(config.authority if config else Authority(), damping=a.damping, tol=a.tol, max_iter=a.max_iter)
            tuning = {"edge_partitions": a.edge_partitions, "checkpoint_every": a.checkpoint_every}
            if a.job == "pagerank":
                jobs.global_pagerank(spark, a.vertices, a.edges, a.out, a.crawl, p, a.n_vertices, **tuning)
            else:
                s = with_overrides(config.seed if config else Seed(), size=a.seed_size, weight=a.seed_weight)
                jobs.personalised_authority(spark, a.vertices, a.edges, a.seed, a.out, a.crawl, p, s, a.n_vertices, **tuning)
        elif a.job == "backlinks":
            print(json.dumps(jobs.backlinks(spark, a.list, a.prefix, a.out, a.crawl, a.run_id), default=str))
        elif a.job == "mart":
            jobs.authority_mart(spark, a.pagerank, a.authority, a.out)
        elif a.job == "overlap":
            print(json.dumps(jobs.rank_overlap(spark, a.pagerank, a.reference, a.out, a.crawl), default=str))
        elif a.job == "publish":
            from webloom.operators import publish

            commands = publish.upload_commands(a.out, a.dataset_id, a.release_tag)
            print(json.dumps(publish.extract_public_index(spark, a.mart, a.out, a.top_n, a.window_id)))
            for c in commands:
                print("would run:", " ".join(c))
        elif a.job == "graph-stats":
            from webloom.operators.graph import graph_stats
            from webloom.sources.readers import read_edges, read_vertices

            print(json.dumps(graph_stats(read_vertices(spark, a.vertices), read_edges(spark, a.edges)).first().asDict()))
    except (WebloomError, ConfigError) as error:
        print(f"{a.job}: {error}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
