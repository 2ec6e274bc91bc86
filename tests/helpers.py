import datetime as dt

from aerolake import schema

DAY = dt.date(2000, 1, 1)


def flight(day=DAY, carrier="AA", number=1, dep=1.0, taxi=2.0, arr=3.0, elapsed=60.0, distance=500.0):
    row = dict.fromkeys(schema.FLIGHT.names)
    row.update(FL_DATE=day, OP_CARRIER=carrier, OP_CARRIER_FL_NUM=number, ORIGIN="A", DEST="B", DEP_DELAY=dep,
               TAXI_OUT=taxi, ARR_DELAY=arr, CRS_ELAPSED_TIME=elapsed, DISTANCE=distance)
    return tuple(row[c] for c in schema.FLIGHT.names)


def flights_frame(spark, rows):
    return spark.createDataFrame(rows, schema.FLIGHT)


def days(n, start=DAY):
    return [start + dt.timedelta(days=i) for i in range(n)]
