"""Default parameters of the engine.  Every one of them can be overridden per call."""

from __future__ import annotations

from dataclasses import dataclass

# Results depend on them, so they equal the published defaults.
TEXT_DIM = 384
IMAGE_DIM = 512
TOP_N_BRANDS = 100
TOP_N_COLORS = 30
WEIGHT_SENTINEL = 999_999_999.0
TEXT_STRUCT_WEIGHT = 0.4
IMAGE_WEIGHT = 0.6
RERANK_DEPTH = 15
CANDIDATE_DEPTH = 100
RRF_K = 60
BM25_K1 = 1.5
BM25_B = 0.75
BM25_EPSILON = 0.25

MODES = ("text_structured", "image", "combined")
HYBRID_MODES = ("text_structured", "combined")


# deviations above the score of its centre up to which a cell is expected to hold hits, where nothing was calibrated; cells
# visited first; and the recall of the ten best that an index is calibrated for
REACH = 3.0
FIRST_CELLS = 4
TARGET_RECALL = 0.95

# neighbours kept of each vector while a proximity graph is learned, twice as many for the search; best items of a query
# from which a search on it goes on
DEGREE = 16
BEAM = 64


@dataclass(frozen=True)
class Search:
    """How dense neighbours are found: exactly, in cells, or on a proximity graph.

    ``ivf`` visits ``nprobe`` cells at first and more of them while lists are not full or the next cell is expected to
    hold a hit: up to ``reach`` deviations above the score of its centre, by default as many as the index was
    calibrated for; with None it stops only where no hit is possible.  ``graph`` goes on from the best ``beam`` items of
    a query while they have neighbours not yet seen.
    """

    kind: str = "exact"
    nprobe: int = FIRST_CELLS
    reach: float | None | str = "calibrated"
    beam: int = BEAM

    def __post_init__(self):
        if self.kind not in ("exact", "ivf", "graph") or self.nprobe < 1 or self.beam < 1:
            raise ValueError(f"unknown search {self}")


EXACT = Search()


@dataclass(frozen=True)
class Limits:
    """Size bounds that choose between physical strategies.

    They never change a result, only the way it is computed.
    """

    # largest vector matrix that may be shipped to every executor
    broadcast_bytes: int = 64 * 1024 * 1024
    # multiply-adds one search task should do
    work_per_task: float = 5e10
    # items searched first to learn a score floor per query
    seed_rows: int = 50_000
    # what the queries of a task with their vectors and lists may take while items stream by
    list_bytes: int = 64 * 1024 * 1024
    # rows of one side of a (cell, part) group on the routed path
    block_rows: int = 4096
    # postings of one term that may sit under one join key
    postings_per_key: int = 100_000
    # queries using one term that may sit under one join key
    queries_per_key: int = 20_000
    # rows of one key that a join keeps together
    rows_per_key: int = 100_000
    # (query, document) pairs one join task should give
    pairs_per_task: int = 5_000_000
    # (query, document) pairs up to which BM25 scores them all by a join
    direct_pairs: int = 1_000_000
    # distinct values that may be collected to pin an exact order statistic
    collect_values: int = 20_000


LIMITS = Limits()
