"""Binary classification with Spark ML: encoding, training, metrics, reports."""
