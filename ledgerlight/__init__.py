"""ledgerlight: company credit-risk analytics as Spark DataFrame plans."""
