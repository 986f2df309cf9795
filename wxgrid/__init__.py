"""wxgrid: regional observation analytics on Spark.

Public surface (all DataFrame -> DataFrame unless noted):

* regional: ``region_day`` (fused region-day table), ``pivot_hours`` /
  ``pivot_hourly_to_columns`` (per-cell pivot), ``aggregate_to_region``,
  ``merge_variables``, ``add_region_name``, ``format_date``,
  ``hour_presence``
* mapping: ``build_mapping``, ``unified_mapping``, ``points_in_polygons``,
  ``reproject_rings``, ``grid_from_rows``, ``grid_from_axes``,
  ``mapping_profile``
* ingest: ``validate``, ``to_long``, ``day_status``, ``quarantine``,
  ``ingest``
* stations / coverage: ``parse_daily``, ``law_id_lookup``, ``clean_keys``,
  ``per_station``, ``duplicate_keys``, ``out_of_range``, ``year_metrics``,
  ``station_churn``
* jobs (write outputs): ``ingest_job``, ``mapping_job``, ``regional_job``,
  ``station_job``, ``coverage_job``; streaming: ``start_ingest_stream``
* readers: ``read_observations``, ``read_mapping``, ``read_polygons``,
  ``read_responses``
* catalogue: ``VARIABLES``, ``spec``, ``ordered_slot_columns``
"""

from .catalogue import VARIABLES, ordered_slot_columns, spec
from .operators.coverage import (clean_keys, duplicate_keys, out_of_range, per_station, station_churn,
                                 year_metrics)
from .operators.ingest import day_status, ingest, quarantine, to_long, validate
from .operators.regional import (add_region_name, aggregate_to_region, format_date, hour_presence,
                                 merge_variables, pivot_hourly_to_columns, pivot_hours, region_day)
from .operators.spatial import (build_mapping, grid_from_axes, grid_from_rows, mapping_profile,
                                points_in_polygons, reproject_rings, unified_mapping)
from .operators.stations import law_id_lookup, parse_daily
from .plans.jobs import coverage_job, ingest_job, mapping_job, regional_job, station_job
from .sources.readers import read_mapping, read_observations, read_polygons, read_responses
from .streaming.landing import start_ingest_stream

__all__ = [
    "VARIABLES", "spec", "ordered_slot_columns",
    "region_day", "pivot_hours", "pivot_hourly_to_columns", "aggregate_to_region", "merge_variables",
    "add_region_name", "format_date", "hour_presence",
    "build_mapping", "unified_mapping", "points_in_polygons", "reproject_rings", "grid_from_rows",
    "grid_from_axes", "mapping_profile",
    "validate", "to_long", "day_status", "quarantine", "ingest",
    "parse_daily", "law_id_lookup", "clean_keys", "per_station", "duplicate_keys", "out_of_range",
    "year_metrics", "station_churn",
    "ingest_job", "mapping_job", "regional_job", "station_job", "coverage_job", "start_ingest_stream",
    "read_observations", "read_mapping", "read_polygons", "read_responses",
]
