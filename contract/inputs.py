"""Inputs of the registered queries, derived from one folder of test tables.

The operators read stored tables in production.  Here the larger derived inputs
are stored once per session, so that each query starts from stored rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seawake.operators.sessionize import sessionize
from seawake.operators.summarize import event_positions, summarize_events, summarize_scalars
from seawake.plans.port_visits import port_visit_events
from seawake.session import configure, materialized
from seawake.sources import samples

START, END = "2024-01-01", "2024-01-04"
RELOAD = "2024-01-03"
LAST_DAY = "2024-01-03"
PREFIX = "ais_"

_stored: dict[tuple[str, str, str], DataFrame] = {}


class Inputs:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder

    def _keep(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _stored:
            _stored[key] = materialized(build())
        return _stored[key]

    def sample(self, name: str) -> DataFrame:
        return getattr(samples, name)(self.spark, self.folder)

    def kept_sample(self, name: str) -> DataFrame:
        return self._keep(name, lambda: self.sample(name))

    @property
    def messages(self) -> DataFrame:
        return self.kept_sample("messages")

    def state(self, score_field: str = "nnet_score", start: str = START, end: str = END) -> DataFrame:
        """Event-tagged messages, as a load of the range leaves them."""
        return self._keep(
            f"state {score_field} {start} {end}", lambda: sessionize(self.messages, start, end, score_field)
        )

    def vessel_inputs(self) -> dict:
        return dict(
            segments=self.sample("segments"),
            segment_vessel=self.sample("segment_vessel"),
            vessels=self.sample("vessels"),
            prefix=PREFIX,
            is_fishing=samples.is_trawler,
        )

    def scalars(self, score_field: str) -> DataFrame:
        return self._keep(
            f"scalars {score_field}",
            lambda: summarize_scalars(
                self.state(score_field), score_field=score_field, **self.vessel_inputs()
            ),
        )

    def filtered(self, score_field: str) -> DataFrame:
        """Filtered events without the point lists."""
        return self._keep(
            f"filtered {score_field}",
            lambda: summarize_events(
                self.state(score_field), score_field=score_field, lists=False, **self.vessel_inputs()
            ),
        )

    def both_filtered(self) -> DataFrame:
        return self.filtered("nnet_score").unionByName(self.filtered("night_loitering"))

    def points(self) -> DataFrame:
        """Positions of the filtered events with the cells of the sample regions."""

        def build() -> DataFrame:
            both = [event_positions(self.state(f), self.scalars(f)) for f in ("nnet_score", "night_loitering")]
            cell = samples.box_cell(F.col("lon"), F.col("lat")).alias("cell")
            return both[0].unionByName(both[1]).select("event_id", "lon", "lat", cell)

        return self._keep("points", build)

    def fishing_measures(self) -> DataFrame:
        events = self.both_filtered()
        corners = events.select(F.col("lon_min").alias("lon"), F.col("lat_min").alias("lat")).unionByName(
            events.select(F.col("lon_max").alias("lon"), F.col("lat_max").alias("lat"))
        )
        return samples.grid_measures(corners)

    @property
    def regions(self) -> DataFrame:
        return self.sample("regions")

    @property
    def port_visits(self) -> DataFrame:
        return self.kept_sample("port_visits")

    def anchorage_measures(self) -> DataFrame:
        return samples.grid_measures(self.sample("anchorages"))

    @property
    def port_events(self) -> DataFrame:
        """Published port-visit events, the input of the two products that name a next port."""
        return self._keep(
            "port events",
            lambda: port_visit_events(
                self.port_visits,
                self.sample("vessels"),
                self.anchorage_measures(),
                self.s2_regions(),
                self.sample("anchorages"),
                LAST_DAY,
                PREFIX,
                edges="planar",
            ),
        )

    @property
    def loitering(self) -> DataFrame:
        return self._keep("loitering", lambda: samples.loitering(self.messages))

    def loitering_measures(self) -> DataFrame:
        rows = self.loitering
        corners = rows.select(F.col("start_lon").alias("lon"), F.col("start_lat").alias("lat")).unionByName(
            rows.select(F.col("end_lon").alias("lon"), F.col("end_lat").alias("lat"))
        )
        return samples.grid_measures(corners)

    def encounter_measures(self) -> DataFrame:
        return samples.grid_measures(
            self.sample("encounters").select(F.col("mean_longitude").alias("lon"), F.col("mean_latitude").alias("lat"))
        )

    def s2_regions(self) -> DataFrame:
        """The sample regions with the S2 cells that hold a mean position inside them.

        Takes the place of a covering: the published plans look points up by
        their S2 cell, and the boxes are far too large to be covered exactly here.
        """
        return self._keep("s2 regions", lambda: samples.covered_regions(self.regions, self.mean_positions()))

    def mean_positions(self) -> DataFrame:
        places = self.sample("anchorages").select("lon", "lat")
        drifting = self.loitering.select(
            ((F.col("start_lon") + F.col("end_lon")) / 2).alias("lon"),
            ((F.col("start_lat") + F.col("end_lat")) / 2).alias("lat"),
        )
        meetings = self.sample("encounters").select(
            F.col("mean_longitude").alias("lon"), F.col("mean_latitude").alias("lat")
        )
        return places.unionByName(drifting).unionByName(meetings)
