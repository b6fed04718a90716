"""Named SQL views."""

from __future__ import annotations

import logging
import re
from collections.abc import Mapping

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import SparkSession

from tidemill.errors import ViewError

log = logging.getLogger(__name__)
_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def create_views(spark: SparkSession, views: Mapping[str, str], temporary: bool = False) -> list[str]:
    """``CREATE OR REPLACE [TEMP] VIEW name AS sql`` for each entry, in order.

    Bad name → code 5 (checked for all before any view is made); SQL syntax
    error → 3; other analysis error → 4. Views made before a failure stay.
    """
    if not isinstance(views, Mapping) or not views:
        raise ViewError(1, "create_views: views must be a non-empty mapping {name: sql}")
    bad = [n for n in views if not isinstance(n, str) or not _NAME.match(n)]
    if bad:
        raise ViewError(5, f"create_views: invalid view names {bad}")
    made = []
    kind = "TEMP VIEW" if temporary else "VIEW"
    for name, sql in views.items():
        if not name.startswith("v_"):
            log.warning("create_views: view %s does not follow the v_ naming convention", name)
        try:
            spark.sql(f"CREATE OR REPLACE {kind} {name} AS {sql}")
        except ParseException as e:
            raise ViewError(3, f"create_views: syntax error in {name}: {e}") from e
        except AnalysisException as e:
            raise ViewError(4, f"create_views: cannot create {name}: {e}") from e
        made.append(name)
    return made
