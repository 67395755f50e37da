"""Fixed values.

Every value below must equal the reference's for results to match; they
are stated here once, in the order the pipeline uses them, and imported by
the operators.
"""

# Fixed values ---------------------------------------------------------------

# Input parsing
INSTANT_PATTERN = "yyyy-MM-dd'T'HH:mm:ss'Z'"  # the reference's "%Y-%m-%dT%H:%M:%SZ", UTC
DEFAULT_SECTOR = "Commercial"

# Plan cleaning
BOUND_FILL = -1.0  # demandMin, demandMax, energyMin, energyMax when missing
FIXED_CHARGE_FILL = 0.0
DAILY_UNIT = "$/day"
MONTHLY_UNIT = "$/month"
DAYS_PER_MONTH = 30.4375
SCHEDULE_FILL = 0  # missing 12x24 schedule
LEGACY_SCHEDULE_FILL = 1  # the legacy jq defaulting

# Units and load
DEFAULT_ENERGY_UNIT = "kWh"
DEFAULT_DEMAND_UNIT = "kW"
HP_PER_KW_DIVISOR = 0.746  # peak in hp = kW / 0.746
KVA_PER_KW_DIVISOR = 0.9  # peak in kVA = kW / 0.9
MONTHLY_USAGE_KWH = 2000.0
PEAK_DEMAND_KW = 500.0

# Schedules
WEEKDAY = "Weekday"
WEEKEND = "Weekend"

# Plan filters
FIXED_CHARGE_LIMIT = 10000.0  # keep fixedChargeFirstMeter < limit
ENERGY_RATE_LIMIT = 100.0  # keep groups whose energy rates are all <= limit
IRRELEVANT_PATTERN = "irrigation|agricultur|agribusiness|pumping|furnace|heating|conditioning|catfish"
IRRIGATION_PATTERN = "irrigation|agricultur|agribusiness|pumping|furnace|heating|conditioning"

# Validation
FIXED_CHARGE_CHECK = 10000.0  # fixedChargeFirstMeter <= check
ENERGY_RATE_CHECK = 100.0  # total_energy_rate <= check
EXCLUDED_NAMES = (
    "agriculture|agricultural|agribusiness|pumping|irrigation|furnace|heating|conditioning|catfish"
)

# Publication
JSON_DECIMALS = 4
