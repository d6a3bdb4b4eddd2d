"""Vocabularies that results depend on."""

from __future__ import annotations

# Stations of the two price areas.
DK1_STATIONS = (
    "05005", "05009", "05015", "05031", "05035", "05042", "05065", "05070", "05075", "05081", "05085", "05089", "05095", "05105", "05109",
    "05135", "05140", "05150", "05160", "05165", "05169", "05185", "05199", "05202", "05205", "05220", "05225", "05269", "05272", "05276",
    "05277", "05290", "05296", "05300", "05305", "05320", "05329", "05343", "05345", "05350", "05355", "05365", "05375", "05381", "05384",
    "05395", "05400", "05406", "05408", "05435", "05440", "05450", "05455", "05469", "06018", "06019", "06023", "06030", "06031", "06032",
    "06034", "06041", "06043", "06049", "06051", "06052", "06056", "06058", "06060", "06065", "06068", "06069", "06070", "06071", "06072",
    "06073", "06074", "06079", "06080", "06081", "06082", "06088", "06089", "06093", "06096", "06102", "06104", "06108", "06109", "06110",
    "06111", "06116", "06118", "06119", "06120", "06123", "06124", "06126", "06132",
)
DK2_STATIONS = (
    "05499", "05505", "05510", "05529", "05537", "05545", "05575", "05735", "05880", "05889", "05935", "05945", "05960", "05970", "05981",
    "05986", "05994", "06135", "06136", "06138", "06141", "06147", "06149", "06151", "06154", "06156", "06159", "06168", "06169", "06170",
    "06174", "06180", "06181", "06183", "06186", "06187", "06188", "06190", "06191", "06193", "06197",
)

# Names of the stations with full weather reports.
STATION_NAMES = {
    "06019": "Silstrup", "06030": "Flyvestation Ålborg", "06031": "Tylstrup", "06032": "Stenhøj", "06034": "Sindal Lufthavn",
    "06041": "Skagen Fyr", "06049": "Hald Vest", "06051": "Vestervig", "06052": "Thyborøn", "06056": "Mejrup", "06058": "Hvide Sande",
    "06060": "Flyvestation Karup", "06065": "Års Syd", "06068": "Isenvad", "06069": "Foulum", "06070": "Århus Lufthavn", "06072": "Ødum",
    "06073": "Sletterhage Fyr", "06074": "Århus Syd", "06079": "Anholt Havn", "06080": "Esbjerg Lufthavn", "06081": "Blåvandshuk Fyr",
    "06082": "Borris", "06088": "Nordby", "06093": "Vester Vedsted", "06096": "Rømø/Juvre", "06102": "Bygholm Landbrugsskole",
    "06104": "Billund Lufthavn", "06108": "Kolding Lufthavn", "06109": "Askov", "06110": "Flyvestation Skrydstrup", "06116": "Store Jyndevad",
    "06118": "Sønderborg Lufthavn", "06119": "Kegnæs Fyr", "06120": "Odense Lufthavn", "06123": "Ørnebjerg", "06124": "Beldringe",
    "06126": "Kirstinebjerg", "06132": "Sydfyns Flyveplads", "06135": "Hammer Odde Fyr", "06138": "Christiansø", "06141": "Rønne Lufthavn",
    "06149": "Gedser", "06151": "Omø Fyr", "06156": "Holbæk Flyveplads", "06159": "Røsnæs Fyr", "06168": "Asnæs", "06169": "Nakkehoved Fyr",
    "06170": "Nordhavn", "06180": "København Lufthavn", "06181": "Jægersborg", "06183": "Drogden Fyr", "06186": "Risø",
    "06187": "Landbohøjskolen", "06188": "Kl. Valby", "06190": "Stevns Fyr", "06193": "Vordingborg",
}

# The parameters of the hourly table, and the features of the load model, in order.
HOURLY_PARAMETERS = (
    "temp_dry", "temp_dew", "temp_grass", "temp_soil", "humidity", "pressure", "pressure_at_sea", "wind_dir", "wind_speed", "wind_max",
    "wind_min", "precip_past10min", "precip_dur_past10min", "visibility", "visib_mean_last10min", "cloud_cover", "cloud_height", "weather",
    "radia_glob", "radia_glob_past1h", "sun_last10min_glob", "leav_hum_dur_past10min",
)
WEATHER_FEATURES = (
    "temp_dry", "temp_dew", "temp_grass", "temp_soil", "wind_speed", "wind_max", "wind_dir", "radia_glob", "radia_glob_past1h",
    "sun_last10min_glob", "precip_past10min", "precip_dur_past10min", "humidity", "pressure", "pressure_at_sea", "cloud_cover",
    "cloud_height", "visibility", "visib_mean_last10min", "leav_hum_dur_past10min", "n_stations",
)
CALENDAR_FEATURES = ("month", "hour", "day")
