"""Parameters of the scoring engine; values that results depend on, in one place."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # fixed values: shares, cut-offs and weights of the scores
    top_share: float = 0.95
    class_a: float = 0.75
    class_b: float = 0.95
    damping: float = 0.85
    w_criticality: float = 0.6
    w_ecosystem: float = 0.2
    w_centrality: float = 0.1
    w_mass: float = 0.1
    min_components: int = 2
    debian_weight: float = 1.39
    homebrew_weight: float = 1.0
    bus_factor_share: float = 0.5
    funding_cap: float = 79.0
    years: tuple[int, ...] = (1996, 1997, 1998, 1999, 2000)
    platforms: tuple[str, ...] = ("github", "gitlab")
    supported_platforms: tuple[str, ...] = ("github", "gitlab")

    def __post_init__(self) -> None:
        unknown = set(self.platforms) - set(self.supported_platforms)
        if unknown:
            raise ValueError(f"platforms without support: {sorted(unknown)}")


PARAMS = Params()
