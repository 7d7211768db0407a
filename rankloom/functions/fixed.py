"""Fixed values.  Results depend on them; they stand together here and are used by name."""

# --- fixed values: link extraction -------------------------------------------------
PAGE_NAME_PATTERN = r"^([^~]+)$"            # a page name is kept when it has no '~'
LINK_PATTERN = r"^\..*/([^~]+)\.html$"      # relative link to an .html file, group 1 = name
BODY_DIV_ID = "bodyContent"                 # links count only inside <div id="bodyContent">
HREF_PATTERN = r'href="([^"]*)"'            # lenient mode: every double-quoted href value

# --- fixed values: rank recurrences -------------------------------------------------
DAMPING = 0.85                              # weight of the link term
TELEPORT = 0.15                             # random-surfing term (1 - DAMPING)
FIXED_POINT_SCALE = 100000                  # dangling mass carried as trunc(rank * 1e5)
LITERAL_FIRST_DELTA = -1.0                  # dangling total fed to the first list sweep
SWEEPS_LIST = 9
SWEEPS_MATRIX = 10
SWEEPS_SPARK = 10
TOP_K = 100

# --- fixed values: station series ---------------------------------------------------
MEASURE_MIN = "TMIN"
MEASURE_MAX = "TMAX"
MISSING_MEAN = -9999.0                      # mean of a measure with no readings in a year
