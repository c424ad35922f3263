"""Declared schemas (DDL text) of the bronze tables, the landing pages and the run history."""

RACE_RESULTS = (
    "season int, round int, race_name string, circuit_id string, circuit_name string, race_date date, "
    "driver_id string, driver_code string, driver_name string, constructor_id string, constructor_name string, "
    "grid int, position int, points double, status string, laps_completed int, time_millis bigint, "
    "fastest_lap_rank string, fastest_lap_time string, avg_speed_kph string, _ingested_at timestamp"
)
QUALIFYING = (
    "season int, round int, race_name string, circuit_id string, driver_id string, driver_name string, "
    "constructor_id string, position int, q1 string, q2 string, q3 string, _ingested_at timestamp"
)
PIT_STOPS = (
    "season int, round int, race_name string, driver_id string, stop_number int, lap int, time_of_day string, "
    "duration string, _ingested_at timestamp"
)
DRIVER_STANDINGS = (
    "season int, driver_id string, driver_name string, constructor_id string, constructor_name string, "
    "position int, points double, wins int, _ingested_at timestamp"
)
LAPS = (
    "season int, round int, session_type string, event_name string, Driver string, LapNumber double, Stint double, "
    "Compound string, TyreLife double, LapTime_seconds double, _ingested_at timestamp"
)

# Landing pages: one JSON document per line, as served by a paged results API.
_DRIVER = "Driver:struct<driverId:string,code:string,givenName:string,familyName:string>"
_TEAM = "constructorId:string,name:string"
_RACE = "season:string,round:string,raceName:string,date:string,Circuit:struct<circuitId:string,circuitName:string>"


RESULT_PAGE = (
    f"MRData struct<total:string,RaceTable:struct<Races:array<struct<{_RACE},Results:array<struct<"
    f"{_DRIVER},Constructor:struct<{_TEAM}>,grid:string,position:string,points:string,status:string,"
    "laps:string,Time:struct<millis:string>,"
    "FastestLap:struct<rank:string,Time:struct<time:string>,AverageSpeed:struct<speed:string>>>>>>>>"
)
QUALIFYING_PAGE = (
    f"MRData struct<total:string,RaceTable:struct<Races:array<struct<{_RACE},QualifyingResults:array<struct<"
    f"{_DRIVER},Constructor:struct<{_TEAM}>,position:string,Q1:string,Q2:string,Q3:string>>>>>>"
)
PIT_STOP_PAGE = (
    f"MRData struct<total:string,RaceTable:struct<Races:array<struct<{_RACE},PitStops:array<struct<"
    "driverId:string,stop:string,lap:string,time:string,duration:string>>>>>>"
)
STANDINGS_PAGE = (
    "MRData struct<total:string,StandingsTable:struct<StandingsLists:array<struct<season:string,"
    f"DriverStandings:array<struct<position:string,points:string,wins:string,{_DRIVER},"
    f"Constructors:array<struct<{_TEAM}>>>>>>>>"
)

RUN_RECORD = (
    "run_id string, ts timestamp, run_date date, "
    "health struct<status:string,row_count:bigint,null_rates:map<string,double>>, "
    "features_proposed int, features_accepted array<struct<name:string,correlation:double>>, "
    "features_rejected array<struct<name:string,correlation:double>>, "
    "model_mae double, worst_circuits array<string>, retrain_triggered boolean, briefing_preview string"
)
