"""Knobs of the engine, in one frozen dataclass."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Knobs:
    # Fixed values of the behaviour we reproduce.
    top_k_similar: int = 100      # neighbours kept per item
    sim_threshold: float = 0.4    # keep cosine strictly above this
    als_rank: int = 100
    als_iterations: int = 5
    als_reg: float = 0.1
    recent_k: int = 20            # recent clicks read per scoring
    candidate_n: int = 20         # candidates kept per click
    queue_cap: int = 40           # recent-click queue length per user
    history_n: int = 20           # entries shown in history / favourites
    recs_n: int = 20              # entries shown from stored recommendations
    batch_seconds: int = 2        # micro-batch interval
    click_prefix: str = "MUSIC_LISTENING_PREFIX:"
    # Grid of the tuning job: ranks x regularisation values.
    grid_ranks: tuple = (50, 100, 200, 300)
    grid_regs: tuple = (0.01, 0.1, 1.0)
    # Ours.
    split_seed: int = 42
    train_percent: int = 80
    als_blocks: int = 16           # library blocks at least (start vectors are drawn by block)
    als_block_ratings: int = 4_000_000   # ratings of a library block beyond that
    als_task_bytes: int = 128 << 20      # factors a task of a half step receives
    als_pass_bytes: int = 1 << 30        # factors that travel at once, or a part of all in so many passes:
    als_passes: int = 16
    als_hot_degree: int = 1_000_000      # ratings of a user that the library solves in one task
    tile_rows: int = 4096          # items of a similarity tile; a task holds tile_rows^2 cosines

    def with_(self, **kw) -> "Knobs":
        return replace(self, **kw)


DEFAULT = Knobs()
