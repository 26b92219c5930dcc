"""Fixed parameters of the registered queries.

Plans never call ``now()``: every window is computed from an explicit as-of
date (M12).  The as-of dates below sit inside the driver tables' time range.
"""

from __future__ import annotations

import datetime as dt

# As-of dates ("today") for the star tables and for the event stream.
STAR_AS_OF = dt.date(1998, 6, 16)
EVENTS_AS_OF = dt.date(2024, 1, 20)
# Configured stores (M10): a short list, as in a store configuration file.
STAR_STORES = ["NATION_0", "NATION_1", "NATION_2"]
# Malls (marketplaces) used by the mall KPI on the star tables.
STAR_MALLS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
