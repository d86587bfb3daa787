"""What every job script shares."""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from velorank.plans.ranks import RankSettings  # noqa: E402

# The option of each field of `RankSettings`, with what it means.
RANK_OPTIONS = {
    "k": ("--K", "vertices in a list of top ranks"),
    "max_iter": ("--max-iter", "most rounds"),
    "epsilon": ("--epsilon", "change below which rounds stop"),
    "damping": ("--d", "share of rank passed along edges"),
    "num_partitions": ("--num-partitions", "partitions of the rank loop; by size if not given"),
}


def add_rank_options(parser: argparse.ArgumentParser) -> None:
    """An option for each field of `RankSettings`, with the field's default."""
    usual = RankSettings()
    for name, (option, meaning) in RANK_OPTIONS.items():
        value = getattr(usual, name)
        parser.add_argument(option, dest=name, default=value, type=float if isinstance(value, float) else int, help=f"{meaning} ({value})")


def rank_settings(args: argparse.Namespace) -> RankSettings:
    return RankSettings(**{name: getattr(args, name) for name in RANK_OPTIONS})


def add_random_graph_options(parser: argparse.ArgumentParser) -> None:
    # The size of a random graph that nothing is said about.
    for option, value in (("--num-nodes", 1000), ("--num-edges", 4000), ("--seed", 42)):
        parser.add_argument(option, type=int, default=value, help=f"of random graphs ({value})")
