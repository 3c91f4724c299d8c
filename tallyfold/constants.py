"""Fixed lookup values the results depend on."""

from __future__ import annotations

# Upper-case state spelling -> official name.
STATE_ALIASES = {
    "A & N ISLANDS": "Andaman & Nicobar Islands",
    "A&N ISLANDS": "Andaman & Nicobar Islands",
    "ANDAMAN & NICOBAR ISLANDS": "Andaman & Nicobar Islands",
    "ANDHRA PRADESH": "Andhra Pradesh",
    "ARUNACHAL PRADESH": "Arunachal Pradesh",
    "ASSAM": "Assam",
    "BIHAR": "Bihar",
    "CHANDIGARH": "Chandigarh",
    "CHHATTISGARH": "Chhattisgarh",
    "D & N HAVELI": "Dadra & Nagar Haveli",
    "D&N HAVELI": "Dadra & Nagar Haveli",
    "DAMAN & DIU": "Daman & Diu",
    "DELHI": "Delhi",
    "DELHI UT": "Delhi",
    "GOA": "Goa",
    "GUJARAT": "Gujarat",
    "HARYANA": "Haryana",
    "HIMACHAL PRADESH": "Himachal Pradesh",
    "JAMMU & KASHMIR": "Jammu & Kashmir",
    "JHARKHAND": "Jharkhand",
    "KARNATAKA": "Karnataka",
    "KERALA": "Kerala",
    "LAKSHADWEEP": "Lakshadweep",
    "MADHYA PRADESH": "Madhya Pradesh",
    "MAHARASHTRA": "Maharashtra",
    "MANIPUR": "Manipur",
    "MEGHALAYA": "Meghalaya",
    "MIZORAM": "Mizoram",
    "NAGALAND": "Nagaland",
    "ODISHA": "Odisha",
    "ORISSA": "Odisha",
    "PONDICHERRY": "Puducherry",
    "PUDUCHERRY": "Puducherry",
    "PUNJAB": "Punjab",
    "RAJASTHAN": "Rajasthan",
    "SIKKIM": "Sikkim",
    "TAMIL NADU": "Tamil Nadu",
    "TELANGANA": "Telangana",
    "TRIPURA": "Tripura",
    "UTTAR PRADESH": "Uttar Pradesh",
    "UTTARAKHAND": "Uttarakhand",
    "UTTARANCHAL": "Uttarakhand",
    "WEST BENGAL": "West Bengal",
}

# Upper-case boundary-file spelling -> statistics spelling.
BOUNDARY_ALIASES = {
    "ANDAMAN AND NICOBAR": "ANDAMAN & NICOBAR ISLANDS",
    "DADRA AND NAGAR HAVELI": "DADRA & NAGAR HAVELI",
    "DAMAN AND DIU": "DAMAN & DIU",
    "JAMMU AND KASHMIR": "JAMMU & KASHMIR",
    "ORISSA": "ODISHA",
    "UTTARANCHAL": "UTTARAKHAND",
}

# Upper-case state -> region.
STATE_REGIONS = {
    "MADHYA PRADESH": "Central",
    "CHHATTISGARH": "Central",
    "MAHARASHTRA": "Western",
    "RAJASTHAN": "Western",
    "GUJARAT": "Western",
    "GOA": "Western",
    "DADRA & NAGAR HAVELI": "Western",
    "DAMAN & DIU": "Western",
    "TAMIL NADU": "Southern",
    "ANDHRA PRADESH": "Southern",
    "KERALA": "Southern",
    "KARNATAKA": "Southern",
    "TELANGANA": "Southern",
    "PUDUCHERRY": "Southern",
    "LAKSHADWEEP": "Southern",
    "UTTAR PRADESH": "Northern",
    "DELHI": "Northern",
    "HARYANA": "Northern",
    "PUNJAB": "Northern",
    "JAMMU & KASHMIR": "Northern",
    "HIMACHAL PRADESH": "Northern",
    "UTTARAKHAND": "Northern",
    "CHANDIGARH": "Northern",
    "BIHAR": "Eastern",
    "WEST BENGAL": "Eastern",
    "ODISHA": "Eastern",
    "JHARKHAND": "Eastern",
    "ANDAMAN & NICOBAR ISLANDS": "Eastern",
    "ASSAM": "North-Eastern",
    "TRIPURA": "North-Eastern",
    "MANIPUR": "North-Eastern",
    "MIZORAM": "North-Eastern",
    "ARUNACHAL PRADESH": "North-Eastern",
    "MEGHALAYA": "North-Eastern",
    "NAGALAND": "North-Eastern",
    "SIKKIM": "North-Eastern",
}
DEFAULT_REGION = "Northern"

# Point used when neither district nor state is known.
NATIONAL_CENTROID = (20.5937, 78.9629)

# Stand-ins for unmatched dimension rows.
DEMOGRAPHIC_DEFAULTS = {
    "POPULATION": 1500000, "POPULATION_DENSITY": 500.0,
    "LITERACY_RATE": 74.0, "URBAN_PERCENTAGE": 30.0,
}
POLICE_DEFAULTS = {
    "POLICE_PER_LAKH": 160.0, "CHARGESHEET_RATE": 78.0, "CONVICTION_RATE": 45.0,
}
PROFILE_DEFAULTS = {
    "POPULATION": 1500000, "CONVICTION_RATE": 45.0, "POLICE_PER_LAKH": 120.0,
    "CHARGESHEET_RATE": 78.0, "LITERACY_RATE": 74.0, "URBAN_PERCENTAGE": 35.0,
}

# Season -> share of the annual total.
SEASON_WEIGHTS = [
    ("Winter (Dec-Feb)", 0.23, "High burglary & theft during fog/low visibility"),
    ("Summer (Mar-May)", 0.27, "Peak violent altercations and property disputes"),
    ("Monsoon (Jun-Aug)", 0.22, "Reduced outdoor mobility, moderate crime volume"),
    ("Festive / Autumn (Sep-Nov)", 0.28,
     "Spike in commercial burglary, thefts, and crowd incidents"),
]

# Share of a week by day, Monday first.
DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
DAY_WEIGHTS = [0.13, 0.13, 0.14, 0.14, 0.16, 0.17, 0.13]

# Share of a day by hour band (night, working day, rest).
NIGHT_WEIGHT, DAY_WEIGHT, REST_WEIGHT = 0.065, 0.045, 0.015
NIGHT_HOURS = (20, 21, 22, 23, 0, 1, 2)
WORK_HOURS = tuple(range(9, 20))

# Class boundaries of the map metrics, highest class first.
METRIC_CLASSES = {
    "violent_pct": [25, 20, 15, 10],
    "women_crimes": [120000, 70000, 30000, 10000],
    "total_crimes": [1800000, 1000000, 500000, 150000],
}

# Head columns that become typed events.
EVENT_TYPES = ["MURDER", "ROBBERY", "BURGLARY", "THEFT", "RIOTS", "CHEATING", "ARSON"]
EVENT_COUNT_CAP = 5
