"""Constants, words, formats and column names that must equal the source
system's for the results to be right. They are stated here once, as plain text, and
imported everywhere else."""

# Status of a booking that took place (bookings sheet, "Estado" column).
WON_STATUS = "Ganado"

# Sale type whose stay (closed - created) is measured.
DINE_IN_SALE_TYPE = "EAT-IN"

# Stay bounds of the dwell subset: at least 50 minutes, less than 4 hours.
DWELL_MIN = "50 minutes"
DWELL_MAX = "4 hours"

# KPI window: days from as_of - 30 (inclusive) to as_of, divided by 30.
TRAILING_DAYS = 30

# Booking months: the months of as_of - 30 days, as_of, and as_of + 30 days.
BOOKING_MONTH_SHIFT_DAYS = 30

# Incremental load: rows dropped from the end of the closed sales before the mark.
LOOKBACK_ROWS = 20

# Display names: longer names are cut to 20 characters followed by "...".
NAME_MAX_CHARS = 20
NAME_ELLIPSIS = "..."

# Currency text of the bookings sheet: prefix, thousands separator, decimal separator.
CURRENCY_PREFIX = "AR$"
THOUSANDS_SEPARATOR = "."
DECIMAL_SEPARATOR = ","

# Day-first date text of the bookings sheet (day and month with or without leading zero).
DAY_FIRST_DATE_PATTERN = "d/M/yyyy"

# Records per page of the point-of-sale API.
API_PAGE_SIZE = 500

# Column names of the raw export files (left) and their entity names (right).
RAW_COLUMN_NAMES = {
    "saleType": "sale_type",
    "createdAt": "created_at",
    "closedAt": "closed_at",
    "paymentMethod": "method",
    "Sucursal": "branch",
}

# Header of the exported bookings sheet (left) and the entity names (right).
SHEET_COLUMN_NAMES = {
    "Fecha Evento": "event_date",
    "Cliente ": "client",
    "Sucursal": "branch",
    "Tipo de menu": "menu",
    "PAX": "guests",
    "Horario": "slot",
    "valor persona (IVA NO INCLUIDO)": "price_per_guest",
    "Total": "total",
    "Estado": "status",
}
