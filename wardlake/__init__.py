"""wardlake: a Spark-native lakehouse for clinical FHIR resources."""
