"""CRM exports to map-ready tables: a bronze / silver / gold engine on Spark."""
