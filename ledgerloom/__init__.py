"""Finance analytics for a retail bank, an e-wallet and a payment gateway, on Spark."""
