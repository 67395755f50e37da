"""PySpark engine that turns nested electricity rate plans into hourly, levelized rate tables.

Entry points (all lazy ``DataFrame -> DataFrame`` unless noted):

* ``read_plans(spark, path)``: JSON plan records with the explicit schema;
* ``clean_plans(records)``: sector filter, dates, newest revision, defaults;
* ``hourly_rates(plans)`` / ``published_rates(plans)``: the 576-row-per-plan table;
* ``rate_json_rows(plans)``: one row per plan with four 12x24 matrices;
* ``run_job(records, out_dir)``: the whole target graph as one job (writes outputs).
"""

from .plans.end_to_end import (  # noqa: F401
    clean_plans,
    hourly_rates,
    published_rates,
    rate_json_rows,
    run_job,
)
from .plans.relational import Load  # noqa: F401
from .sources.publish import read_plans  # noqa: F401

__version__ = "0.1.0"
