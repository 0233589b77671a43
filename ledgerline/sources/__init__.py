"""ledgerline.sources"""
