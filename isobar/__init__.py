"""isobar: Spark operators for weather-station and coastal-ocean observations."""
