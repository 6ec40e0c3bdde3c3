"""K6: dataset layout under one base URI (local path, HDFS, object store)."""

from __future__ import annotations

from dataclasses import dataclass


# Numeric columns of the named datasets, and candidate files in their order.
COLUMN_TYPES = {
    "total_streams": "bigint", "streams": "bigint", "year": "int", "pop": "double",
    "popularity": "double", "mean_popularity": "double", "media_pop": "double", "score": "double",
}
GENERATION_STATS_FILES = ("generation_stats.csv", "metricas_por_geracao.csv")
TOP_ARTISTS_FILES = ("top_artists_by_gen.csv", "top_artistas_por_geracao.csv", "artist_trends.csv")


@dataclass(frozen=True)
class Layout:
    base: str

    def candidates(self, names: tuple[str, ...]) -> list[str]:
        return [self._join("processed", n) for n in names]

    def _join(self, *parts: str) -> str:
        return "/".join([self.base.rstrip("/"), *parts])

    @property
    def raw(self) -> str:
        return self._join("raw")

    @property
    def interim(self) -> str:
        return self._join("interim")

    @property
    def processed(self) -> str:
        return self._join("processed")

    @property
    def figures(self) -> str:
        return self._join("processed", "figures")

    @property
    def reports(self) -> str:
        return self._join("processed", "reports")

    # named datasets
    @property
    def raw_tracks(self) -> str:
        return self._join("raw", "tracks.csv")

    @property
    def tracks(self) -> str:
        return self._join("processed", "tracks.parquet")

    @property
    def tracks_csv(self) -> str:
        return self._join("processed", "tracks.csv")

    @property
    def generation_stats(self) -> str:
        return self._join("processed", "generation_stats.csv")

    @property
    def artist_trends(self) -> str:
        return self._join("processed", "artist_trends.csv")

    @property
    def top_artists_by_gen(self) -> str:
        return self._join("processed", "top_artists_by_gen.csv")

    @property
    def enriched_tracks(self) -> str:
        return self._join("processed", "spotify_with_clusters.csv")

    @property
    def genre_share(self) -> str:
        return self._join("processed", "genre_share_by_generation.csv")
