"""Message schemas, summary tables and fixed values."""

# Field names and types of the messages, as the senders write them.
METER = """
    date_time STRING, id STRING, city STRING, `P (watt)` INT, `V (volt)` INT, `I (amphere)` FLOAT
"""
DEVICE_INT = """
    CCD STRING, COST FLOAT, DID INT, DSN STRING, ID INT,
    KPWR INT, KPWS INT, KPWT INT, LAMPWH INT, SN STRING, STIME STRING
"""
DEVICE_FLOAT = """
    CCD STRING, COST FLOAT, DID INT, DSN STRING, ID INT,
    KPWR FLOAT, KPWS FLOAT, KPWT FLOAT, LAMPWH FLOAT, SN STRING, STIME STRING
"""
DEVICE_COST = "STIME STRING, DID INT, DSN STRING, COST FLOAT"
LAMP = "id_kWh INT, city STRING, watt INT, I FLOAT, timestamp STRING"

# The meters' cities by id, the lamps' cities by meter, and the usual power range in watts.
CITIES = {1: "Surabaya", 2: "Sidoarjo", 3: "Gresik", 4: "Malang", 5: "Pasuruan"}
LAMP_CITIES = {"Surabaya": [1, 2, 3], "Sidoarjo": [4, 5, 6]}
METER_BAND = (250, 300)
LAMP_BAND = (40, 70)

# Fixed value: how summaries write the start of their window.
TIME_TEXT = "yyyy-MM-dd HH:mm:ss"

# Summary tables. Totals are wider than the readings they add up (INT -> BIGINT, FLOAT -> DOUBLE).
METER_SUMMARY = """
    timestamp STRING, id STRING, city STRING, total_watt BIGINT, total_volt BIGINT, total_amphere DOUBLE,
    avg_watt DOUBLE, avg_volt DOUBLE, avg_amphere DOUBLE
"""
CITY_SUMMARY = METER_SUMMARY.replace("id STRING, ", "")
COST_SUMMARY = "timestamp TIMESTAMP, DID INT, DSN STRING, total_cost DOUBLE"
