"""Fixed values the results depend on: labels, word lists, thresholds and bounds."""

# Countries per circuit region; any other country is "Other".
EUROPE = ["UK", "Germany", "Italy", "France", "Spain", "Belgium"]
AMERICAS = ["USA", "Canada", "Mexico", "Brazil", "Argentina"]
ASIA_PACIFIC = ["Japan", "China", "Singapore", "Malaysia", "Bahrain", "UAE"]

# Result codes.
FINISH_TEXTS = [str(place) for place in range(1, 21)]
DNF_TEXTS = ["R", "D", "F"]
PODIUM_PLACES = [1, 2, 3]

# Valid ranges, both ends included.
POSITION_RANGE = (1, 50)
POINTS_RANGE = (0, 50)
LAPS_RANGE = (1, 100)
STOP_RANGE = (1, 10)
PIT_MS_RANGE = (1000, 300000)
YEAR_RANGE = (1950, 2030)
LATITUDE_RANGE = (-90, 90)
LONGITUDE_RANGE = (-180, 180)

# Upper bounds (exclusive) of pit categories in milliseconds.
PIT_CATEGORIES = [(20000, "Fast"), (25000, "Normal"), (30000, "Slow")]
PIT_CATEGORY_LAST = "Very Slow"

# Date formats tried in this order.
DATE_FORMATS = ["yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy", "yyyy-MM-dd HH:mm:ss"]

# Circuit names that mark street circuits and wet races.
STREET_PATTERN = "(Monaco|Singapore|Baku|Melbourne)"
WET_PATTERN = "(Monaco|Singapore|Belgium)"

# Weights of wins and podiums in the dominance score.
DOMINANCE_WIN = 25
DOMINANCE_PODIUM = 18

# Segment labels by mean win rate (exclusive lower bounds), then by mean consistency.
SEGMENT_BY_WIN_RATE = [(0.2, "Elite Champions"), (0.1, "Race Winners"), (0.05, "Podium Contenders")]
SEGMENT_CONSISTENCY = (0.7, "Consistent Finishers")
SEGMENT_LAST = "Development Drivers"

# Names of the four fixed performance segments, best first.
FOUR_SEGMENTS = ["Elite Performers", "Consistent Midfielders", "Rising Talents", "Backmarkers"]

# Merge keys and update columns of the results table.
RESULT_MERGE_KEYS = ["raceId", "driverId", "constructorId"]
RESULT_UPDATE_COLUMNS = ["position", "points", "laps", "positionText"]

# Retention per layer in days, and quality warning thresholds per layer in percent.
RETENTION_DAYS = {"bronze": 365, "silver": 730, "gold": 1825}
WARNING_PERCENT = {"bronze": 5.0, "silver": 2.0, "gold": 1.0}
