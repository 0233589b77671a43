"""ledgerline.operators"""
