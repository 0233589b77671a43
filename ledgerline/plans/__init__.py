"""ledgerline.plans"""
