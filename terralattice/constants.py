"""Fixed values of the imagery product: names, ranges, flags and recipes.

Everything in this module is a fixed value that must equal the published one
for results to be right. Logic that uses them lives elsewhere.
"""

# Product file names, matched from the start of the name.
FILENAME_PATTERN = (
    r"^OR_ABI-L2-MCMIP([FCM])-M(\d)_G(\d{2})_s(\d{14})_e(\d{14})_c(\d{14})\.nc"
)
FILENAME_FIELDS = ("scene", "mode", "satellite", "start", "end", "created")

# Attribute domains.
ORBITAL_SLOTS = ("GOES-East", "GOES-West", "GOES-Test", "GOES-Storage")
PLATFORMS = ("G16", "G17", "G18", "G19")
SCENES = ("Full Disk", "CONUS", "Mesoscale")

# File attribute -> observation column.
PROMOTED_ATTRS = {
    "id": "observation_id",
    "dataset_name": "dataset_name",
    "naming_authority": "naming_authority",
    "platform_ID": "platform_id",
    "orbital_slot": "orbital_slot",
    "instrument_type": "instrument_type",
    "instrument_ID": "instrument_id",
    "scene_id": "scene_id",
    "timeline_id": "scan_mode",
    "spatial_resolution": "spatial_resolution",
    "time_coverage_start": "time_coverage_start",
    "time_coverage_end": "time_coverage_end",
    "date_created": "date_created",
    "production_site": "production_site",
    "production_environment": "production_environment",
    "production_data_source": "production_data_source",
    "processing_level": "processing_level",
    "Conventions": "conventions",
    "Metadata_Conventions": "metadata_conventions",
    "standard_name_vocabulary": "standard_name_vocabulary",
    "title": "title",
    "summary": "summary",
    "institution": "institution",
    "project": "project",
    "license": "license",
    "keywords": "keywords",
    "keywords_vocabulary": "keywords_vocabulary",
    "cdm_data_type": "cdm_data_type",
    "iso_series_metadata_id": "iso_series_metadata_id",
}
TIME_ATTRS = ("time_coverage_start", "time_coverage_end", "date_created")

# Band number, name, wavelength in um, valid minimum, valid maximum.
BANDS = (
    (1, "Blue", 0.47, 0.0, 1.0),
    (2, "Red", 0.64, 0.0, 1.0),
    (3, "Veggie", 0.86, 0.0, 1.0),
    (4, "Cirrus", 1.37, 0.0, 1.0),
    (5, "Snow/Ice", 1.61, 0.0, 1.0),
    (6, "Cloud Particle Size", 2.24, 0.0, 1.0),
    (7, "Shortwave Window", 3.9, 197.3, 411.86),
    (8, "Upper-Level Water Vapor", 6.19, 138.05, 311.06),
    (9, "Mid-Level Water Vapor", 6.93, 137.7, 311.08),
    (10, "Lower-Level Water Vapor", 7.34, 126.91, 331.2),
    (11, "Cloud-Top Phase", 8.44, 127.69, 341.3),
    (12, "Ozone", 9.61, 117.49, 311.06),
    (13, "Clean Longwave Window", 10.33, 89.62, 341.27),
    (14, "Longwave Window", 11.21, 96.19, 341.28),
    (15, "Dirty Longwave Window", 12.29, 97.38, 341.28),
    (16, "CO2 Longwave", 13.28, 92.7, 318.26),
)
ALL_BANDS = tuple(range(1, 17))
LAST_REFLECTANCE_BAND = 6

# Band number -> products that use it.
BAND_PRODUCTS = {
    1: ("Aerosol detection", "Aerosol optical depth", "Clear-sky masks",
        "Cloud and moisture imagery", "Cloud optical depth",
        "Cloud particle size distribution", "Downward solar insolation surface",
        "Reflected solar insolation TOA", "Snow cover", "Radiances"),
    2: ("Aerosol detection", "Aerosol optical depth", "Clear-sky masks",
        "Cloud and moisture imagery", "Cloud optical depth",
        "Cloud particle size distribution", "Cloud-top phase",
        "Downward solar insolation surface", "Reflected solar insolation TOA",
        "Derived motion winds", "Fire/hotspot characterization",
        "Land surface temperature", "Snow cover", "Sea surface temperature",
        "Volcanic ash: Detection/height", "Radiances"),
    3: ("Aerosol detection", "Clear-sky masks", "Cloud and moisture imagery",
        "Downward solar insolation surface", "Reflected solar insolation TOA",
        "Derived motion winds", "Snow cover", "Radiances"),
    4: ("Aerosol detection", "Clear-sky masks", "Cloud and moisture imagery",
        "Downward solar insolation surface", "Reflected solar insolation TOA",
        "Radiances"),
    5: ("Aerosol detection", "Clear-sky masks", "Cloud and moisture imagery",
        "Cloud particle size distribution", "Downward solar insolation surface",
        "Reflected solar insolation TOA", "Snow cover", "Radiances"),
    6: ("Aerosol detection", "Aerosol optical depth", "Clear-sky masks",
        "Cloud and moisture imagery", "Cloud optical depth",
        "Cloud particle size distribution", "Downward solar insolation surface",
        "Reflected solar insolation TOA", "Snow cover", "Radiances"),
    7: ("Aerosol detection", "Clear-sky masks", "Cloud and moisture imagery",
        "Cloud-top phase", "Cloud-top height", "Cloud-top pressure",
        "Cloud-top temperature", "Rainfall rate/QPE",
        "Downward solar insolation surface", "Reflected solar insolation TOA",
        "Derived motion winds", "Fire/hotspot characterization", "Snow cover",
        "Volcanic ash: Detection/height", "Radiances"),
    8: ("Clear-sky masks", "Cloud and moisture imagery", "Hurricane intensity",
        "Rainfall rate/QPE", "Legacy vertical moisture profile",
        "Legacy vertical temperature profile", "Derived stability indices",
        "Total precipitable water", "Derived motion winds", "Radiances"),
    9: ("Clear-sky masks", "Cloud and moisture imagery", "Rainfall rate/QPE",
        "Legacy vertical moisture profile", "Legacy vertical temperature profile",
        "Derived stability indices", "Total precipitable water",
        "Derived motion winds", "Radiances"),
    10: ("Clear-sky masks", "Cloud and moisture imagery", "Rainfall rate/QPE",
         "Legacy vertical moisture profile", "Legacy vertical temperature profile",
         "Derived stability indices", "Total precipitable water",
         "Derived motion winds", "Radiances"),
    11: ("Clear-sky masks", "Cloud and moisture imagery", "Cloud-top phase",
         "Cloud-top height", "Cloud-top pressure", "Cloud-top temperature",
         "Legacy vertical moisture profile", "Legacy vertical temperature profile",
         "Derived stability indices", "Total precipitable water",
         "Sea surface temperature", "Radiances"),
    12: ("Clear-sky masks", "Cloud and moisture imagery",
         "Legacy vertical moisture profile", "Legacy vertical temperature profile",
         "Derived stability indices", "Total precipitable water", "Radiances"),
    13: ("Aerosol detection", "Clear-sky masks", "Cloud and moisture imagery",
         "Cloud-top phase", "Cloud-top height", "Cloud-top pressure",
         "Cloud-top temperature", "Rainfall rate/QPE",
         "Legacy vertical moisture profile", "Legacy vertical temperature profile",
         "Derived stability indices", "Total precipitable water",
         "Derived motion winds", "Land surface temperature",
         "Sea surface temperature", "Volcanic ash: Detection/height", "Radiances"),
    14: ("Aerosol detection", "Clear-sky masks", "Cloud and moisture imagery",
         "Cloud-top phase", "Cloud-top height", "Cloud-top pressure",
         "Cloud-top temperature", "Legacy vertical moisture profile",
         "Legacy vertical temperature profile", "Derived stability indices",
         "Total precipitable water", "Derived motion winds",
         "Fire/hotspot characterization", "Land surface temperature",
         "Sea surface temperature", "Volcanic ash: Detection/height", "Radiances"),
    15: ("Clear-sky masks", "Cloud and moisture imagery", "Cloud-top height",
         "Cloud-top pressure", "Cloud-top temperature",
         "Legacy vertical moisture profile", "Legacy vertical temperature profile",
         "Derived stability indices", "Total precipitable water",
         "Sea surface temperature", "Volcanic ash: Detection/height", "Radiances"),
    16: ("Clear-sky masks", "Cloud and moisture imagery",
         "Legacy vertical moisture profile", "Legacy vertical temperature profile",
         "Derived stability indices", "Total precipitable water", "Radiances"),
}

# Quality flag code, name, meaning. 5 and 6 come from regridding.
DQF_FLAGS = (
    (0, "GOOD", "good_pixels_qf"),
    (1, "CONDITIONALLY_USABLE", "conditionally_usable_pixels_qf"),
    (2, "OUT_OF_RANGE", "out_of_range_pixels_qf"),
    (3, "NO_VALUE", "no_value_pixels_qf"),
    (4, "FOCAL_PLANE_TEMP_EXCEEDED", "focal_plane_temperature_threshold_exceeded_qf"),
    (5, "INTERPOLATED", "interpolated_qf"),
    (6, "NAN_SOURCE", "nan_source"),
)

# Regridding thresholds.
DIRECT_HIT_WEIGHT = 0.999
INTEGER_EPSILON = 1e-6
OUTSIDE_FLAG = 3
MIXED_FLAG = 5
NAN_FLAG = 6

# RGB recipes, one row per channel.
# (composite, when, channel, {band: coefficient}, clip unit, clip low, clip high, gamma, invert)
# Units: pct = reflectance x 100, C = degrees Celsius, K = kelvin, frac = reflectance.
# day_convection B is a reflectance fraction; simple_water_vapor uses its K bounds.
COMPOSITES = (
    ("blowing_snow", "day", "r", {2: 1.0}, "pct", 0.0, 50.0, 0.7, False),
    ("blowing_snow", "day", "g", {5: 1.0}, "pct", 0.0, 20.0, 1.0, False),
    ("blowing_snow", "day", "b", {7: 1.0, 13: -1.0}, "C", 0.0, 30.0, 0.7, False),
    ("dust_cvd", "both", "r", {13: 1.0, 11: -1.0}, "C", -0.5, 6.0, 1.5, False),
    ("dust_cvd", "both", "g", {15: 1.0, 13: -1.0}, "C", -6.0, 2.5, 1.5, False),
    ("dust_cvd", "both", "b", {13: 1.0}, "C", -40.0, 40.0, 1.0, False),
    ("day_cloud_type", "day", "r", {4: 1.0}, None, None, None, 0.66, False),
    ("day_cloud_type", "day", "g", {2: 1.0}, None, None, None, 1.0, False),
    ("day_cloud_type", "day", "b", {5: 1.0}, None, None, None, 1.0, False),
    ("rocket_plume_night", "both", "r", {7: 1.0}, "K", 273.0, 338.0, 1.0, False),
    ("rocket_plume_night", "both", "g", {8: 1.0}, "K", 220.0, 280.0, 1.0, False),
    ("rocket_plume_night", "both", "b", {10: 1.0}, "K", 230.0, 290.0, 1.0, False),
    ("rocket_plume_day", "day", "r", {7: 1.0}, "K", 273.0, 338.0, 1.0, False),
    ("rocket_plume_day", "day", "g", {8: 1.0}, "K", 233.0, 253.0, 1.0, False),
    ("rocket_plume_day", "day", "b", {2: 1.0}, "pct", 0.0, 80.0, 1.0, False),
    ("nighttime_microphysics", "night", "r", {15: 1.0, 13: -1.0}, "C", -6.7, 2.6, 1.0, False),
    ("nighttime_microphysics", "night", "g", {13: 1.0, 7: -1.0}, "C", -3.1, 5.2, 1.0, False),
    ("nighttime_microphysics", "night", "b", {13: 1.0}, "C", -29.6, 19.5, 1.0, False),
    ("so2", "both", "r", {9: 1.0, 10: -1.0}, "C", -4.0, 2.0, 1.0, False),
    ("so2", "both", "g", {13: 1.0, 11: -1.0}, "C", -4.0, 5.0, 1.0, False),
    ("so2", "both", "b", {13: 1.0}, "C", -30.1, 29.8, 1.0, False),
    ("day_snow_fog", "day", "r", {3: 1.0}, "pct", 0.0, 100.0, 1.7, False),
    ("day_snow_fog", "day", "g", {5: 1.0}, "pct", 0.0, 70.0, 1.7, False),
    ("day_snow_fog", "day", "b", {7: 1.0, 13: -1.0}, "C", 0.0, 30.0, 1.7, False),
    ("day_cloud_phase_distinction", "day", "r", {13: 1.0}, "C", -53.5, 7.5, 1.0, False),
    ("day_cloud_phase_distinction", "day", "g", {2: 1.0}, "pct", 0.0, 78.0, 1.0, False),
    ("day_cloud_phase_distinction", "day", "b", {5: 1.0}, "pct", 1.0, 59.0, 1.0, False),
    ("ash", "both", "r", {15: 1.0, 13: -1.0}, "K", -6.7, 2.6, 1.0, False),
    ("ash", "both", "g", {14: 1.0, 11: -1.0}, "K", -6.0, 6.3, 1.0, False),
    ("ash", "both", "b", {13: 1.0}, "K", 243.6, 302.4, 1.0, False),
    ("day_cloud_convection", "day", "r", {2: 1.0}, "pct", 0.0, 100.0, 1.7, False),
    ("day_cloud_convection", "day", "g", {2: 1.0}, "pct", 0.0, 100.0, 1.7, False),
    ("day_cloud_convection", "day", "b", {13: 1.0}, "C", -70.15, 49.85, 1.0, False),
    ("cimss_natural_true_color", "day", "r", {2: 1.0}, None, None, None, None, False),
    ("cimss_natural_true_color", "day", "g", {2: 0.45, 3: 0.10, 1: 0.45}, None, None, None, None, False),
    ("cimss_natural_true_color", "day", "b", {1: 1.0}, None, None, None, None, False),
    ("air_mass", "both", "r", {8: 1.0, 10: -1.0}, "C", -26.2, 0.6, 1.0, False),
    ("air_mass", "both", "g", {12: 1.0, 13: -1.0}, "C", -43.2, 6.7, 1.0, False),
    ("air_mass", "both", "b", {8: 1.0}, "C", -64.65, -29.25, 1.0, True),
    ("day_convection", "day", "r", {8: 1.0, 10: -1.0}, "C", -35.0, 5.0, 1.0, False),
    ("day_convection", "day", "g", {7: 1.0, 13: -1.0}, "C", -5.0, 60.0, 1.0, False),
    ("day_convection", "day", "b", {5: 1.0, 2: -1.0}, "frac", -0.75, 0.25, 1.0, False),
    ("day_land_cloud", "day", "r", {5: 1.0}, "pct", 0.0, 97.5, 1.0, False),
    ("day_land_cloud", "day", "g", {3: 1.0}, "pct", 0.0, 108.6, 1.0, False),
    ("day_land_cloud", "day", "b", {2: 1.0}, "pct", 0.0, 100.0, 1.0, False),
    ("day_land_cloud_fire", "day", "r", {6: 1.0}, "pct", 0.0, 100.0, 1.0, False),
    ("day_land_cloud_fire", "day", "g", {3: 1.0}, "pct", 0.0, 100.0, 1.0, False),
    ("day_land_cloud_fire", "day", "b", {2: 1.0}, "pct", 0.0, 100.0, 1.0, False),
    ("differential_water_vapor", "both", "r", {10: 1.0, 8: -1.0}, "C", -3.0, 30.0, 0.2587, True),
    ("differential_water_vapor", "both", "g", {10: 1.0}, "C", -60.0, 5.0, 0.4, True),
    ("differential_water_vapor", "both", "b", {8: 1.0}, "C", -64.65, -29.25, 0.4, True),
    ("dust", "both", "r", {15: 1.0, 13: -1.0}, "C", -6.7, 2.6, 1.0, False),
    ("dust", "both", "g", {14: 1.0, 11: -1.0}, "C", -0.5, 20.0, 2.5, False),
    ("dust", "both", "b", {13: 1.0}, "C", -11.95, 15.55, 1.0, False),
    ("fire_temperature", "both", "r", {7: 1.0}, "C", 0.0, 60.0, 0.4, False),
    ("fire_temperature", "both", "g", {6: 1.0}, "pct", 0.0, 100.0, 1.0, False),
    ("fire_temperature", "both", "b", {5: 1.0}, "pct", 0.0, 75.0, 1.0, False),
    ("simple_water_vapor", "both", "r", {13: 1.0}, "K", 202.29, 278.96, None, True),
    ("simple_water_vapor", "both", "g", {8: 1.0}, "K", 214.66, 242.67, None, True),
    ("simple_water_vapor", "both", "b", {10: 1.0}, "K", 245.12, 261.03, None, True),
)

# Band differences (name, minuend band, subtrahend band, units, when, sign classes).
DIFFERENCES = (
    ("split_water_vapor", 8, 10, "K", "both", ()),
    ("split_ozone", 12, 13, "K", "both", ()),
    ("split_cloud_phase", 14, 11, "K", "both", ()),
    ("split_snow", 5, 2, "reflectance", "day", ("positive", "negative")),
    ("night_fog", 13, 7, "K", "both", ("night_positive", "night_negative", "day_negative")),
    ("split_window", 13, 15, "K", "both", ("positive", "negative")),
)
