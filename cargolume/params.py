"""Business parameters. All of them are defaults; operators take them as arguments."""

# Controlled vocabularies.
VEHICLES = ["Diesel Truck", "Electric Semi", "Hybrid Van"]
WEATHER = ["Normal", "Rain", "Storm", "Snow"]
TRAFFIC = ["Low", "Medium", "High"]
HIGH, MEDIUM, LOW = "High Risk", "Medium Risk", "Low Risk"
TIERS = [HIGH, MEDIUM, LOW]

# Emission model (kg CO2 per ton-km, kg per leg, multipliers, floor in kg).
EMISSION_FACTOR = {"Diesel Truck": 0.13, "Electric Semi": 0.035, "Hybrid Van": 0.08}
BASE_EMISSION = {"Diesel Truck": 8.0, "Electric Semi": 1.5, "Hybrid Van": 4.0}
WEATHER_CO2 = {"Normal": 1.00, "Rain": 1.03, "Storm": 1.08, "Snow": 1.06}
TRAFFIC_CO2 = {"Low": 1.00, "Medium": 1.04, "High": 1.10}
CO2_FLOOR_KG = 0.5
CARBON_PRICE = 50.0

# Freight model (dollars per ton-km, dollars per leg) and late penalty.
FREIGHT_RATE = {"Diesel Truck": 0.085, "Electric Semi": 0.062, "Hybrid Van": 0.098}
FREIGHT_FIXED = {"Diesel Truck": 42.0, "Electric Semi": 96.0, "Hybrid Van": 28.0}
SLA_PENALTY = 850.0

# Risk tiers.
COST_RATIO = 4.0
HIGH_THRESHOLD = 0.50
MEDIUM_THRESHOLD = 0.20

# Delay-risk index (log-odds).
WEATHER_LOGIT = {"Normal": 0.00, "Rain": 0.60, "Storm": 2.00, "Snow": 1.40}
TRAFFIC_LOGIT = {"Low": 0.00, "Medium": 0.50, "High": 1.20}
WEATHER_AMPLIFIER = {"Normal": 0.00, "Rain": 0.20, "Storm": 0.75, "Snow": 0.50}
VENDOR_CENTRE, VENDOR_SLOPE = 3.25, 0.80
DISTANCE_CENTRE, DISTANCE_SPAN, DISTANCE_SLOPE = 694.0, 1800.0, 0.50

# Delay severity (Poisson mean).
SEVERITY_BASE = 0.30
WEATHER_SEVERITY = {"Normal": 0.00, "Rain": 0.25, "Storm": 1.10, "Snow": 0.75}
TRAFFIC_SEVERITY = {"Low": 0.00, "Medium": 0.15, "High": 0.45}
SEVERITY_VENDOR, SEVERITY_FLOOR, MAX_DELAY_DAYS = 0.18, 0.05, 5
TARGET_DELAY_RATE = 0.22

# Dispatch utilities.
DISPATCH_BASE = {"Diesel Truck": 0.72, "Electric Semi": -0.42, "Hybrid Van": -0.18}
DISPATCH_DISTANCE = {"Diesel Truck": 0.45, "Electric Semi": -0.25, "Hybrid Van": -0.70}
DISPATCH_WEIGHT = {"Diesel Truck": 0.35, "Electric Semi": 0.30, "Hybrid Van": -1.00}
DISPATCH_DISTANCE_SCALE, DISPATCH_WEIGHT_CENTRE, DISPATCH_WEIGHT_SCALE = 900.0, 13.0, 12.0
FLEET_BIAS_SD = 0.45

# Geography.
EARTH_RADIUS_KM = 6371.0088
ROAD_DETOUR = 1.25

# Contract bounds.
MAX_DISTANCE_KM = 5000.0
MAX_WEIGHT_TONS = 100.0
MAX_ROW_WEIGHT_TONS = 60.0
MAX_DISTANCE_CV = 0.15
MAX_DELAY_CONTRACT = 30
MAX_VEHICLE_SPREAD = 0.05
MIN_CALIBRATION_ROWS = 100
LOGIT_CLIP = 1e-6

# Allocation tie-break towards lower emissions.
SLACK_WEIGHT = 1e-3
