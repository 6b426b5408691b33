"""geohealth: population-health, climate and drone-imagery analytics as Spark jobs."""
