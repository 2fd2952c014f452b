"""Station dimension: the published list of 100 stations.

A small literal table, broadcast-safe by construction (its size is fixed in
code). ``city_dim`` returns it as a DataFrame with an explicit schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CITY_SCHEMA = "city string, country string, lat double, lon double"

# fixed values: the station list (city, country, latitude, longitude), in the
# published order. 100 entries.
CITY_ROWS = [
    ("New York", "US", 40.7128, -74.0060),
    ("Los Angeles", "US", 34.0522, -118.2437),
    ("Chicago", "US", 41.8781, -87.6298),
    ("Houston", "US", 29.7604, -95.3698),
    ("Phoenix", "US", 33.4484, -112.0740),
    ("Philadelphia", "US", 39.9526, -75.1652),
    ("San Antonio", "US", 29.4241, -98.4936),
    ("San Diego", "US", 32.7157, -117.1611),
    ("Dallas", "US", 32.7767, -96.7970),
    ("San Francisco", "US", 37.7749, -122.4194),
    ("Seattle", "US", 47.6062, -122.3321),
    ("Denver", "US", 39.7392, -104.9903),
    ("Toronto", "CA", 43.6532, -79.3832),
    ("Vancouver", "CA", 49.2827, -123.1207),
    ("Montreal", "CA", 45.5017, -73.5673),
    ("Mexico City", "MX", 19.4326, -99.1332),
    ("Guadalajara", "MX", 20.6597, -103.3496),
    ("São Paulo", "BR", -23.5505, -46.6333),
    ("Rio de Janeiro", "BR", -22.9068, -43.1729),
    ("Buenos Aires", "AR", -34.6037, -58.3816),
    ("Lima", "PE", -12.0464, -77.0428),
    ("Bogotá", "CO", 4.7110, -74.0721),
    ("Santiago", "CL", -33.4489, -70.6693),
    ("Caracas", "VE", 10.4806, -66.9036),
    ("London", "GB", 51.5074, -0.1278),
    ("Paris", "FR", 48.8566, 2.3522),
    ("Berlin", "DE", 52.5200, 13.4050),
    ("Madrid", "ES", 40.4168, -3.7038),
    ("Rome", "IT", 41.9028, 12.4964),
    ("Amsterdam", "NL", 52.3676, 4.9041),
    ("Brussels", "BE", 50.8503, 4.3517),
    ("Vienna", "AT", 48.2082, 16.3738),
    ("Stockholm", "SE", 59.3293, 18.0686),
    ("Oslo", "NO", 59.9139, 10.7522),
    ("Copenhagen", "DK", 55.6761, 12.5683),
    ("Helsinki", "FI", 60.1699, 24.9384),
    ("Warsaw", "PL", 52.2297, 21.0122),
    ("Prague", "CZ", 50.0755, 14.4378),
    ("Budapest", "HU", 47.4979, 19.0402),
    ("Bucharest", "RO", 44.4268, 26.1025),
    ("Athens", "GR", 37.9838, 23.7275),
    ("Lisbon", "PT", 38.7223, -9.1393),
    ("Zurich", "CH", 47.3769, 8.5417),
    ("Dublin", "IE", 53.3498, -6.2603),
    ("Moscow", "RU", 55.7558, 37.6173),
    ("Kiev", "UA", 50.4501, 30.5234),
    ("Cairo", "EG", 30.0444, 31.2357),
    ("Lagos", "NG", 6.5244, 3.3792),
    ("Nairobi", "KE", -1.2921, 36.8219),
    ("Johannesburg", "ZA", -26.2041, 28.0473),
    ("Cape Town", "ZA", -33.9249, 18.4241),
    ("Casablanca", "MA", 33.5731, -7.5898),
    ("Accra", "GH", 5.6037, -0.1870),
    ("Addis Ababa", "ET", 9.0320, 38.7469),
    ("Dar es Salaam", "TZ", -6.7924, 39.2083),
    ("Dakar", "SN", 14.7167, -17.4677),
    ("Tunis", "TN", 36.8065, 10.1815),
    ("Algiers", "DZ", 36.7372, 3.0865),
    ("Dubai", "AE", 25.2048, 55.2708),
    ("Riyadh", "SA", 24.7136, 46.6753),
    ("Tehran", "IR", 35.6892, 51.3890),
    ("Istanbul", "TR", 41.0082, 28.9784),
    ("Baghdad", "IQ", 33.3152, 44.3661),
    ("Doha", "QA", 25.2854, 51.5310),
    ("Kuwait City", "KW", 29.3759, 47.9774),
    ("Amman", "JO", 31.9454, 35.9284),
    ("Tokyo", "JP", 35.6762, 139.6503),
    ("Mumbai", "IN", 19.0760, 72.8777),
    ("Delhi", "IN", 28.6139, 77.2090),
    ("Bangalore", "IN", 12.9716, 77.5946),
    ("Kolkata", "IN", 22.5726, 88.3639),
    ("Singapore", "SG", 1.3521, 103.8198),
    ("Seoul", "KR", 37.5665, 126.9780),
    ("Beijing", "CN", 39.9042, 116.4074),
    ("Shanghai", "CN", 31.2304, 121.4737),
    ("Shenzhen", "CN", 22.5431, 114.0579),
    ("Hong Kong", "HK", 22.3193, 114.1694),
    ("Bangkok", "TH", 13.7563, 100.5018),
    ("Jakarta", "ID", -6.2088, 106.8456),
    ("Kuala Lumpur", "MY", 3.1390, 101.6869),
    ("Manila", "PH", 14.5995, 120.9842),
    ("Dhaka", "BD", 23.8103, 90.4125),
    ("Karachi", "PK", 24.8607, 67.0011),
    ("Lahore", "PK", 31.5204, 74.3587),
    ("Colombo", "LK", 6.9271, 79.8612),
    ("Kathmandu", "NP", 27.7172, 85.3240),
    ("Yangon", "MM", 16.8661, 96.1951),
    ("Ho Chi Minh", "VN", 10.8231, 106.6297),
    ("Hanoi", "VN", 21.0285, 105.8542),
    ("Taipei", "TW", 25.0330, 121.5654),
    ("Osaka", "JP", 34.6937, 135.5023),
    ("Sydney", "AU", -33.8688, 151.2093),
    ("Melbourne", "AU", -37.8136, 144.9631),
    ("Brisbane", "AU", -27.4698, 153.0251),
    ("Perth", "AU", -31.9505, 115.8605),
    ("Auckland", "NZ", -36.8509, 174.7645),
    ("Adelaide", "AU", -34.9285, 138.6007),
    ("Wellington", "NZ", -41.2866, 174.7756),
    ("Gold Coast", "AU", -28.0167, 153.4000),
    ("Canberra", "AU", -35.2809, 149.1300),
]


def city_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CITY_ROWS, CITY_SCHEMA)


def absent_stations(dim: DataFrame, batch: DataFrame, key: str | list[str] = "city") -> DataFrame:
    """Stations of the dimension without any document in a batch."""
    return dim.join(batch.select(key).distinct(), key, "left_anti")
